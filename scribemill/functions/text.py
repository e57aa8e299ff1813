"""Text functions: column expressions, and Arrow UDFs where Spark has no function (numbers in words, NFKC, word differences)."""

from __future__ import annotations

import functools
import html
import re
import string
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from scribemill.functions import edits as E

# Spellings, abbreviations and symbols, replaced in this order.
CORRECTIONS = [
    ("bl.a", "bl.a."), ("d.v.s ", "d.v.s. "), ("d. v.s.", "d.v.s."), ("fr.o.m", "fr.o.m."), ("kungl. maj: t", "kungl. maj:t"), ("m. m.", "m.m."), ("m.m ", "m.m. "),
    ("m. fl.", "m.fl."), ("milj. kr.", "milj.kr."), ("o. s.v.", "o.s.v."), ("s. k.", "s.k."), ("t.o.m,", "t.o.m."), ("t.o. m.", "t.o.m."),
]
ABBREVIATIONS = [
    ("bl.a.", "bland annat"), ("d.v.s.", "det vill säga"), ("dvs.", "det vill säga"), ("e.d.", "eller dylikt"), ("f.d.", "före detta"), ("f.n.", "för närvarande"),
    ("f.ö.", "för övrigt"), ("fr.o.m.", "från och med"), ("inkl.", "inklusive"), ("k.m:t", "kunglig majestät"), ("kungl. maj:t", "kunglig majestät"), ("m.a.o.", "med andra ord"),
    ("milj.kr.", "miljoner kronor"), ("m.m.", "med mera"), ("m.fl.", "med flera"), ("o.d.", "och dylikt"), ("o.dyl.", "och dylikt"), ("o.s.v.", "och så vidare"), ("osv.", "och så vidare"),
    ("p.g.a.", "på grund av"), ("s.a.s.", "så att säga"), ("s.k.", "så kallad"), ("t.o.m.", "till och med"), ("t.ex.", "till exempel"), ("t.v.", "tills vidare"), ("kungl.", "kungliga"),
]
SYMBOLS = [("%", "procent")]
# Stems of sound cues in capitals.
CUE_STEMS = (
    "TJUT GRÅT SKRATT SKRIK LJUD MUSIK HÖRS VRÅL SNARK FRÄSA BRUMMA KNACK RING RÖST PRAT ÅSKA VIND REGN HUND MOTOR BIL STORM DROP STEG GLAS KROCK KLOCKA JUBLAR BUAR APPLÅD KLICK SLAG DUNK SORL "
    "MUMMEL GNYR VISSLA TJUTER GAP SUCK PUST HARKLAR FJÄT KNÄCK SKRAMMEL PRASSLA FLÄMT FLADDRA VÅG BRIS SPRICKA SPRÄNGNING PANG FÖNSTER DÖRR RULLAR SLÄPAR TUTA LARM SKALL VIBRATION TAPPAR DUNKA "
    "MULLER FÖNSTERKROSS KRAFT KNÄCKTES RASSLA"
).split()
# Rewriting rules for ground-truth text, in order, as Java patterns.
CLEANING = [
    (r"- -|– –", " "), (r"/[^\n]*?/", " "), (r"\([^\n]*?\)", ""), (r"\[[^\n]*?\]", ""), (r"(?U)<[/a-zA-Z\s]+>", ""), (r"\*[^\n]*?\*", ""), (r"^[-–]+|[-–]+$", ""),
    (r"(?<=>)[-–]", ""), (r"[-–](?=<)", ""), (r"(?<=>)\.\.\.", ""), (r"(?U)(?<=\s)[-–](?=\w)|(?<=\w)[-–](?=\s)", ""), (r"(?U)(?<=\s)[-–](?=\.\.\.)", ""), (r"^\.\.\.", ""), (r"(?dm)^([^\n]+)\.\.\. \.\.\.", "$1 "),
]
CAPITALS = r"(?U)\b[A-ZÅÄÖ]+\b(?:\s+\b[A-ZÅÄÖ]+\b)*"

UNITS = "noll ett två tre fyra fem sex sju åtta nio tio elva tolv tretton fjorton femton sexton sjutton arton nitton".split()
TENS = "_ _ tjugo trettio fyrtio femtio sextio sjuttio åttio nittio".split()


def rewritten(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Regular-expression rules, one after the other."""
    return functools.reduce(lambda t, r: F.regexp_replace(t, *r), rules, text)


def substituted(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """Plain replacements, one after the other."""
    return functools.reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def expand_abbreviations(text: Column) -> Column:
    """Corrections, then abbreviations, then symbols, without regard to word boundaries."""
    return substituted(text, CORRECTIONS + ABBREVIATIONS + SYMBOLS)


def collapse(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+", " ")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def delete_punctuation(text: Column) -> Column:
    """Without the 32 ASCII punctuation characters."""
    return F.translate(text, string.punctuation, "")


def swedish(n: int) -> str:
    """A whole number below a billion (10^9) in Swedish words."""
    if n < 20:
        return UNITS[n]
    if n < 100:
        return TENS[n // 10] + (UNITS[n % 10] if n % 10 else "")
    if n < 1000:
        return UNITS[n // 100] + "hundra" + (swedish(n % 100) if n % 100 else "")
    if n < 10**6:
        return swedish(n // 1000) + "tusen" + (" " + swedish(n % 1000) if n % 1000 else "")
    many = "en miljon" if n // 10**6 == 1 else f"{swedish(n // 10**6)} miljoner"
    return many + (" " + swedish(n % 10**6) if n % 10**6 else "")


def swedish_digits(digits: str) -> str:
    """A run of decimal digits of any length in Swedish words: nine digits at a time, each group that is followed by
    another a number of billions (miljarder) of it."""
    digits = digits.lstrip("0") or "0"
    first = len(digits) % 9 or 9
    groups = [int(digits[:first]), *(int(digits[k : k + 9]) for k in range(first, len(digits), 9))]
    words = [swedish(groups[0])]
    for k, group in enumerate(groups[1:]):
        if k == 0 and groups[0] == 1:
            words = ["en miljard"]
        else:
            words.append("miljarder")
        if group:
            words.append(swedish(group))
    return " ".join(words)


DIGITS, PUNCTUATION = re.compile(r"\d+"), str.maketrans("", "", string.punctuation)
# White space of Unicode, as (?U)\s of Java has it.
SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def said(text: str) -> str:
    """Runs of decimal digits in words, no ASCII punctuation, NFKC."""
    plain = lambda run: run if run.isascii() else "".join(str(unicodedata.decimal(c)) for c in run)
    text = DIGITS.sub(lambda m: swedish_digits(plain(m[0])), text).translate(PUNCTUATION)
    return text if text.isascii() else unicodedata.normalize("NFKC", text)


def single_spaced(text: str) -> str:
    """Without white space at the ends, and with one space for each run of it. A printable text has no other than spaces."""
    return " ".join(text.split()) if text.isprintable() else SPACES.sub(" ", text).strip(" ")


def expanded(text: str) -> str:
    """Corrections, abbreviations (all with a full stop) and symbols."""
    for old, new in CORRECTIONS + ABBREVIATIONS if "." in text else ():
        text = text.replace(old, new)
    for old, new in SYMBOLS:
        text = text.replace(old, new)
    return text


@F.arrow_udf(StringType())
def spoken(text: pa.Array) -> pa.Array:
    """Runs of decimal digits in words, no ASCII punctuation, NFKC: all that has no Spark function, in one call. A way
    round Python for plain texts costs more than the call."""
    return pa.array([None if t is None else said(t) for t in text.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def normalized(text: pa.Array) -> pa.Array:
    """Abbreviations, numbers, punctuation and white space in one call: forty replacements cost Spark more, and it would
    make the last ones anew for every use of the text."""
    return pa.array([None if t is None else single_spaced(said(expanded(t))) for t in text.to_pylist()], pa.string())


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def normalize_text(text: Column) -> Column:
    """Lower case, no abbreviations, numbers in words, no punctuation, single spaces."""
    return normalized(F.lower(text))


def normalize_text_svt(text: Column) -> Column:
    """The same with hyphens and dashes between words as spaces, and what stands between slashes removed."""
    apart = rewritten(expand_abbreviations(F.lower(text)), [(r"(?U)(?<=\s)–\b", ""), (r"(?U)(?<=\w)-(?=\w)", " "), (r"(?U)(?<=\w)–(?=\w)", " "), (r"/[^\n]*?/", " ")])
    return strip(collapse(rewritten(F.replace(spoken(apart), F.lit("\n"), F.lit(" ")), [("^-+", ""), ("^–+", "")])))


def normalize_for_scores(text: Column, spell: bool = False) -> Column:
    """For evaluation: lower case; digits stay (what is neither word character nor space becomes a space) or are
    spelled out."""
    low = F.lower(text)
    return strip(collapse(spoken(low) if spell else F.regexp_replace(low, r"(?U)[^\w\s]", " ")))


def clean_subtitle(text: Column) -> Column:
    """Single spaces, and turns of dialogue on one line joined by a space."""
    return substituted(collapse(text), [("- -", " "), ("– –", " ")])


def drop_cues(text: Column) -> Column:
    """All segments in capitals, if the first of them has a sound cue."""
    first = F.regexp_extract(text, f"({CAPITALS})", 1)
    return F.when(F.regexp_like(first, F.lit(r"(?U)\b(?:" + "|".join(rf"{x}\w*" for x in CUE_STEMS) + r")\b")), F.regexp_replace(text, CAPITALS, "")).otherwise(text)


def clean_text(text: Column, cues: bool = False, compose: bool = True) -> Column:
    """Ground-truth text without stage directions, tags and dashes; with `cues`, without sound cues in capitals."""
    out = rewritten(nfkc(text) if compose else text, CLEANING)
    return strip(collapse(drop_cues(out) if cues else out))


def timestamp_tokens(text: Column) -> Column:
    """<1.20> as <|1.20|>."""
    return F.regexp_replace(text, r"<(\d{1,2}\.\d{2})>", r"<|$1|>")


def without_tags(text: Column) -> Column:
    return F.regexp_replace(text, r"<[^>]*?>", "")


def word_count(text: Column) -> Column:
    return F.size(split_words(text))


def split_words(text: Column) -> Column:
    """Words between white space, none for blank text."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def seconds_token(ms: Column, mark: str = "<", end: str = ">") -> Column:
    """Milliseconds, floored to 20, as seconds with two digits; made from whole numbers."""
    hundredths = (F.floor(ms / 20) * 2).cast("long")
    whole = F.floor(hundredths / 100).cast("long")
    return F.concat(F.lit(mark), whole.cast("string"), F.lit("."), F.lpad((hundredths - whole * 100).cast("string"), 2, "0"), F.lit(end))


@F.arrow_udf(StringType())
def marked_words(reference: pa.Array, hypothesis: pa.Array) -> pa.Array:
    codes_a, of_a, codes_b, of_b, known = E.coded_words(reference, hypothesis)
    words = [html.escape(w) for w in known.to_pylist()]
    marked = [*words, *(f"<del>{w}</del>" for w in words), *(f"<ins>{w}</ins>" for w in words)]
    pair, kind, at_a, at_b, length = E.edit_scripts(codes_a, of_a, codes_b, of_b)
    run, _, place = E.spread(np.where(kind == E.INSERTED, at_b, at_a), length)
    inserted, word = (kind == E.INSERTED)[run], np.empty(len(run), np.int64)
    word[inserted], word[~inserted] = codes_b[place[inserted]], codes_a[place[~inserted]]
    shown = [marked[x] for x in (kind[run] * len(words) + word).tolist()]
    upto = np.searchsorted(pair[run], np.arange(len(of_a))).tolist()
    out = [" ".join(shown[i:k]) for i, k in zip(upto, upto[1:], strict=False)]
    missing = np.any([c.is_null().to_numpy(zero_copy_only=False) for c in (reference, hypothesis)], axis=0)
    return pa.array(out, pa.string(), mask=missing)


def difference_html(reference: Column, hypothesis: Column) -> Column:
    """Words of a line-up of two texts, with <del> and <ins> around those of one text only; null if a text is null.

    A shortest script of deletions and insertions is shown; where several are, another one than other tools show.
    """
    return marked_words(reference, hypothesis)
