"""Names of programmes, recordings and files taken apart, as column expressions. A name of another form gives nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dialect recordings whose transcription is of low quality.
EXCLUDED_RECORDINGS = (
    "far_om_1s_far_om_2s oru_ym_1s vim_ow_1s pit_om_1s arj_yw_2s arj_ow_1s vim_yw_3s pit_ym_3s nys_yw_3s bar_om_1s "
    "sko_ym_3s arj_ym_3s nys_om_1s hal_ym_1s vim_om_3s pit_yw_3s far_ym_3s far_ow_1s_far_ow_2s far_yw_1s fao_om_1s"
).split()


def parts(name: Column, mark: str, fields: tuple[str, ...]) -> dict[str, Column]:
    """The fields of a name that has just so many between marks."""
    found = F.split(name, mark)
    return {k: F.when(F.size(found) == len(fields), F.get(found, F.lit(i))) for i, k in enumerate(fields)}


def dialect_parts(name: Column) -> dict[str, Column]:
    return parts(name, "_", ("location", "speaker_id", "version"))


def broadcast_parts(name: Column) -> dict[str, Column]:
    return parts(name, "-", ("program_id", "split"))


def broadcast_date(year: Column, month: Column, day: Column) -> Column:
    """A date; null for one that does not exist."""
    return F.try_to_timestamp(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")), F.lit("yyyy-MM-dd")).cast("date")


def clock_time(digits: Column) -> Column:
    """HH:MM:SS of the first six digits of hhmmss, as text or as a number without its leading zeros."""
    six = F.when(F.length(digits.cast("string")) >= 6, F.left(digits.cast("string"), F.lit(6))).otherwise(F.lpad(digits.cast("string"), 6, "0"))
    return F.concat_ws(":", *(F.substring(six, i, 2) for i in (1, 3, 5)))


def recording_name(name: Column) -> Column:
    """The audio file's name of a transcription's: without .gloss or, where there is none, _gloss."""
    return F.when(F.contains(name, F.lit(".gloss")), F.replace(name, F.lit(".gloss"), F.lit(""))).otherwise(F.replace(name, F.lit("_gloss"), F.lit("")))


def recording_area(place: Column) -> Column:
    """The last two parts of a place's path."""
    steps = F.split(place, "/")
    return F.array_join(F.slice(steps, F.greatest(F.size(steps) - 1, F.lit(1)), F.lit(2)), "/")


def program_of_chunk(file_name: Column) -> Column:
    """A chunk's programme: the words of its file name but for the last two, between underscores."""
    words = F.regexp_extract_all(file_name, F.lit(r"(?U)[\w']+"), F.lit(0))
    return F.array_join(F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))), "_")


def snr_channel(path: Column) -> Column:
    """What stands between the first 11 and the last 34 characters."""
    return F.substr(path, F.lit(12), F.greatest(F.length(path) - 45, F.lit(0)))


def prefixed(prefix: str, name: Column) -> Column:
    return F.concat(F.lit(prefix), name)
