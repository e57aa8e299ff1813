"""Array, map and time functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Token numbers of the languages of a speech model, one after the other.
LANGUAGE_IDS = {code: 50259 + k for k, code in enumerate((
    "en zh de es ru ko fr ja pt tr pl ca nl ar sv it id hi fi vi he uk el ms cs ro da hu ta no th ur hr "
    "bg lt la mi ml cy sk te fa lv bn sr az sl kn et mk br eu is hy ne mn bs kk sq sw gl mr pa si km sn "
    "yo so af oc ka be tg sd gu am yi lo uz fo ht ps tk nn mt sa lb my bo tl mg as tt haw ln ha ba jw su"
).split())}


def language_id(code: Column) -> Column:
    """The token number of a language; null for others."""
    return F.array_position(F.array(*map(F.lit, LANGUAGE_IDS)), code) + F.when(code.isin(*LANGUAGE_IDS), 50258)


def token_languages(tokens: Column) -> Column:
    """Languages of the special tokens that name one, which are those of 6 or 7 characters (<|sv|>, <|haw|>)."""
    return F.transform(F.filter(tokens, lambda t: F.length(t).isin(6, 7)), lambda t: F.substr(t, F.lit(3), F.length(t) - 4))


def model_of_kind(names: Column, kind: str) -> Column:
    """The last name of the kind: wav2vec2 by that word, whisper by that word and not the former."""
    said = lambda n: F.when(F.contains(F.lower(n), F.lit("wav2vec2")), "wav2vec2").when(F.contains(F.lower(n), F.lit("whisper")), "whisper")
    return F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.filter(names, lambda n: said(n) == kind)), -1)


def softmax(scores: Column, among: Column | None = None) -> Column:
    """Probabilities of an array of scores; with `among` (array of booleans), the others have probability 0.

    The maximum and the sum are computed once for the array: each is passed on as a one-element array.
    """
    kept = scores if among is None else F.zip_with(scores, among, lambda s, m: F.when(m, s).otherwise(F.lit(float("-inf"))))
    powers = F.flatten(F.transform(F.array(F.array_max(kept)), lambda most: F.transform(kept, lambda s: F.exp(s - most))))
    total = lambda p: F.aggregate(p, F.lit(0.0), lambda a, b: a + b)
    return F.flatten(F.transform(F.array(powers), lambda p: F.flatten(F.transform(F.array(total(p)), lambda t: F.transform(p, lambda x: x / t)))))


def by_probability(probabilities: Column) -> Column:
    """Entries of a map (language, probability), the most probable first; ties by language."""
    entries = F.transform(F.map_entries(probabilities), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("key"), e["value"].alias("value")))
    return F.transform(F.array_sort(entries), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))


def top_languages(probabilities: Column, n: int = 5, always: str = "sv") -> Column:
    """The n most probable languages, and `always` whatever its rank."""
    ranked = by_probability(probabilities)
    rest = F.filter(F.slice(ranked, n + 1, 1_000_000), lambda e: e["key"] == always)
    return F.map_from_entries(F.concat(F.slice(ranked, 1, n), rest))


def likeliest(probabilities: Column) -> Column:
    return F.get(by_probability(probabilities), F.lit(0))["key"]


def map_upsert(maps: Column, model: Column, value: Column, replace_all: bool = False) -> Column:
    """The map with the model's value, if the model is absent; or a map of it alone."""
    own = F.create_map(model, value)
    if replace_all:
        return own
    return F.when(maps.isNull(), own).when(F.map_contains_key(maps, model), maps).otherwise(F.map_concat(maps, own))


def list_upsert(entries: Column, entry: Column, how: str = "append") -> Column:
    """Transcriptions by model. append: if the model is absent; model: replace the model's entries, never append;
    all: the entry alone."""
    if how == "all":
        return F.array(entry)
    if how == "model":
        return F.transform(entries, lambda e: F.when(e["model"] == entry["model"], entry).otherwise(e))
    return F.when(F.exists(entries, lambda e: e["model"] == entry["model"]), entries).otherwise(F.array_append(entries, entry))


def frames(ms: Column, rate: int = 16_000) -> Column:
    """Samples in so many milliseconds, by way of seconds, truncated."""
    return (ms / 1000 * rate).cast("long")


def audio_slice(audio: Column, start_frame: Column, end_frame: Column) -> Column:
    """Samples [start, end)."""
    return F.slice(audio, (start_frame + 1).cast("int"), F.greatest(end_frame - start_frame, F.lit(0)).cast("int"))


def padded(values: Column, n: Column) -> Column:
    """Zeros appended up to n."""
    return F.concat(values, F.array_repeat(F.lit(0.0).cast("float"), (n - F.size(values)).cast("int")))


def prompt(tokens: Column, start: Column, most: int = 192) -> Column:
    """The start token and the last most - 1 tokens."""
    return F.concat(F.array(start), F.slice(tokens, F.greatest(F.size(tokens) - (most - 2), F.lit(1)), most - 1))


def clock(ms: Column) -> Column:
    """(h, m, s, us) of milliseconds; hours may pass 23."""
    whole = lambda x: F.floor(x).cast("long")
    return F.struct(whole(ms / 3_600_000).alias("h"), F.pmod(whole(ms / 60_000), F.lit(60)).alias("m"), F.pmod(whole(ms / 1000), F.lit(60)).alias("s"), (F.pmod(ms, F.lit(1000)) * 1000).alias("us"))


def srt_ms(stamp: Column) -> Column:
    """hh:mm:ss,mmm as milliseconds."""
    part = lambda i: F.regexp_extract(stamp, r"(\d+):(\d+):(\d+)[,.](\d+)", i).cast("long")
    return ((part(1) * 60 + part(2)) * 60 + part(3)) * 1000 + part(4)


def seconds_to_ms(seconds: Column) -> Column:
    """Milliseconds, rounded half to even."""
    return F.rint(seconds * 1000).cast("long")


def floor20(ms: Column) -> Column:
    return (F.floor(ms / 20) * 20).cast("long")


def nearest20_seconds(ms: Column) -> Column:
    """The nearest 20 ms (half to even) in seconds."""
    return F.bround(ms / 20) * 20 / 1000


def word_times(offsets: Column, step: float) -> Column:
    """Word offsets in frames as seconds."""
    return F.transform(offsets, lambda w: F.struct(w["word"].alias("word"), F.bround(w["start_offset"] * step, 2).alias("start_time"), F.bround(w["end_offset"] * step, 2).alias("end_time")))


# What ln(mean |x|) - mean(ln |x|) is for speech in noise at -20, -19, ... 100 dB.
SNR_RATIOS = [
    0.40974774, 0.40986926, 0.40998566, 0.40969089, 0.40986186, 0.40999006, 0.41027138, 0.41052627, 0.41101024, 0.41143264, 0.41231718,
    0.41337272, 0.41526426, 0.4178192, 0.42077252, 0.42452799, 0.42918886, 0.43510373, 0.44234195, 0.45161485, 0.46221153, 0.47491647,
    0.48883809, 0.50509236, 0.52353709, 0.54372088, 0.56532427, 0.58847532, 0.61346212, 0.63954496, 0.66750818, 0.69583724, 0.72454762,
    0.75414799, 0.78323148, 0.81240985, 0.84219775, 0.87166406, 0.90030504, 0.92880418, 0.95655449, 0.9835349, 1.01047155, 1.0362095,
    1.06136425, 1.08579312, 1.1094819, 1.13277995, 1.15472826, 1.17627308, 1.19703503, 1.21671694, 1.23535898, 1.25364313, 1.27103891,
    1.28718029, 1.30302865, 1.31839527, 1.33294817, 1.34700935, 1.3605727, 1.37345513, 1.38577122, 1.39733504, 1.40856397, 1.41959619,
    1.42983624, 1.43958467, 1.44902176, 1.45804831, 1.46669568, 1.47486938, 1.48269965, 1.49034339, 1.49748214, 1.50435106, 1.51076426,
    1.51698915, 1.5229097, 1.528578, 1.53389835, 1.5391211, 1.5439065, 1.54858517, 1.55310776, 1.55744391, 1.56164927, 1.56566348,
    1.56938671, 1.57307767, 1.57654764, 1.57980083, 1.58304129, 1.58602496, 1.58880681, 1.59162477, 1.5941969, 1.59693155, 1.599446,
    1.60185011, 1.60408668, 1.60627134, 1.60826199, 1.61004547, 1.61192472, 1.61369656, 1.61534074, 1.61688905, 1.61838916, 1.61985374,
    1.62135878, 1.62268119, 1.62390423, 1.62513143, 1.62632463, 1.6274027, 1.62842767, 1.62945532, 1.6303307, 1.63128026, 1.63204102,
]


def snr_db(audio: Column, ratios: list[float] = SNR_RATIOS, first_db: int = -20) -> Column:
    """Signal-to-noise ratio from the distribution of amplitudes: ln(mean |x|) - mean(ln |x|) of the samples scaled to
    their peak, between the last table value below it and the next one; the ends hold beyond the table."""
    magnitude = F.transform(audio, lambda v: F.abs(v.cast("double")))
    scaled = F.flatten(F.transform(F.array(F.array_max(magnitude)), lambda peak: F.transform(magnitude, lambda v: F.greatest(v / peak, F.lit(1e-10)))))
    mean = lambda x: F.aggregate(x, F.lit(0.0), lambda a, b: a + b) / F.size(x)
    level = F.transform(F.array(scaled), lambda x: F.log(mean(x)) - mean(F.transform(x, lambda v: F.log(v))))
    table, n = F.array(*map(F.lit, ratios)), len(ratios)

    def decibels(level):
        at = F.coalesce(F.array_max(F.filter(F.sequence(F.lit(1), F.lit(n)), lambda i: F.get(table, i - 1) < level)), F.lit(0))
        between = lambda i: first_db + i - 1 + (level - F.get(table, i - 1)) / (F.get(table, i) - F.get(table, i - 1))
        found = F.transform(F.array(at), lambda i: F.when(i == 0, F.lit(float(first_db))).when(i == n, F.lit(float(first_db + n - 1))).otherwise(between(i)))
        return F.get(found, F.lit(0))

    return F.get(F.transform(level, decibels), F.lit(0))
