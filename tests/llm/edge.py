"""A small table with what operators must bear: nulls, empty and long texts, copies, equal rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, block string, kept string, node string, data string"


def rows(n: int = 60, seed: int = 4, null_ids: bool = False) -> list[tuple]:
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(300)]
    sentence = lambda k: " ".join(r.choice(words) for _ in range(k))
    shared, line = sentence(60), "A line that many documents have"
    out = []
    for i in range(n):
        text = sentence(r.randint(1, 120))
        if i % 4 == 0:
            text += " " + shared
        if i % 5 == 0:
            text = f"{line}\n{text}\n  {line.upper()} "
        if i % 7 == 0 and out:
            text = out[-3][1]
        if i % 9 == 0 and out:
            text = (out[-1][1] or "") + " " + r.choice(words)
        out.append((i, text, r.choice(["en", "de", None]), r.choice(["a", "b", "é", "\U0001f600", None]), len(text)))
    out += [(n, None, None, None, None), (n + 1, "", "en", "a", 0), (n + 2, " \n\t ", "en", "b", 4), (n + 3, "x", "en", "b", 1), (n + 4, "x", None, "b", 1)]
    out += [(n + 5, sentence(9000), "en", "a", 1), (n + 5 + 1, "tail white  \n", "en", "a", 1), (n + 7, "odd  space  \x1c end　", "en", None, 1)]
    out += [out[3], out[3]]  # equal rows
    if null_ids:
        out += [(None, out[5][1], "en", "a", 1), (None, sentence(40), "en", None, 1), (None, None, None, None, None)]
    return [x + ("clash",) * 6 for x in out]


def documents(spark, **options):
    return spark.createDataFrame(rows(**options), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ascii_lower(x: str) -> str:
    return x.translate({k: k + 32 for k in range(65, 91)})
