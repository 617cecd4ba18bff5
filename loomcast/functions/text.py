"""Text functions as Columns; the few that need order-dependent scans are Arrow UDFs in text_udfs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTENCE_END = r"[.!?]\s*$"


def normalise_for_dedup(text: Column, removals: Sequence[str], stop_words: Sequence[str]) -> Column:
    """Lower case, removals in order, then words that are no stop words and hold no digit."""
    out = F.lower(text)
    for pattern in removals:
        out = F.regexp_replace(out, pattern, " ")
    words = F.filter(F.split(F.trim(out), r"\s+"), lambda w: ~w.isin(*stop_words) & ~w.rlike(r"\d") & (w != ""))
    return F.array_join(words, " ")


def normalise_word(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), r"(?U)[^\w]", "")


def remove_unknown(text: Column) -> Column:
    """Drops <unk> marks and the space they leave."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"<unk>", ""), r"\s+", " "))


def cap_word_runs(text: Column, most: int = 3) -> Column:
    """At most `most` equal words in a row, compared without case."""
    def step(acc: Column, w: Column) -> Column:
        same = acc["last"].eqNullSafe(F.lower(w))
        n = F.when(same, acc["n"] + 1).otherwise(F.lit(1))
        return F.struct(
            F.when(n <= most, F.concat(acc["out"], F.array(w))).otherwise(acc["out"]).alias("out"),
            F.lower(w).alias("last"), n.alias("n"),
        )

    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(None).cast("string").alias("last"), F.lit(0).alias("n"))
    return F.aggregate(F.split(F.trim(text), r"\s+"), start, step, lambda acc: F.array_join(acc["out"], " "))


def is_contentless(text: Column) -> Column:
    """At most two characters, or only punctuation and white space."""
    bare = F.trim(F.coalesce(text, F.lit("")))
    return (F.length(bare) <= 2) | ~bare.rlike(r"(?U)\w")


def word_count(text: Column) -> Column:
    bare = F.trim(F.coalesce(text, F.lit("")))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, r"\s+")))


def ends_sentence(text: Column) -> Column:
    return text.rlike(SENTENCE_END)


def truncate_description(text: Column, most: int = 200, share: float = 0.7) -> Column:
    """Cut at `most` characters, back to the last space if that keeps over `share` of them, with an ellipsis."""
    cut = F.substring(text, 1, most)
    back = F.locate(" ", F.reverse(cut))
    at = F.lit(most) - back
    whole = F.when((back > 0) & (at > most * share), F.substr(cut, F.lit(1), at)).otherwise(cut)
    return F.when(F.length(text) <= most, text).otherwise(F.concat(whole, F.lit("...")))


def normalise_name(name: Column) -> Column:
    """Lower case without titles, suffixes, brackets and punctuation."""
    out = F.regexp_replace(F.lower(name), r"\([^)]*\)", " ")
    out = F.regexp_replace(out, r"(?U)[^\w\s]", "")
    out = F.regexp_replace(out, r"\b(dr|mr|mrs|ms|prof|jr|sr|ii|iii|iv)\b", " ")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def name_quality(name: Column) -> Column:
    """Points for two or more words, capitals, length; none for labels and digits."""
    score = (
        F.when(F.size(F.split(F.trim(name), r"\s+")) >= 2, 0.4).otherwise(0.1) + F.when(name.rlike(r"^[A-Z]"), 0.2).otherwise(0.0)
        + F.when(F.length(name).between(4, 40), 0.2).otherwise(0.0) + F.when(~name.rlike(r"\d"), 0.2).otherwise(0.0)
    )
    return F.when(name.isNull() | name.rlike(r"^SPEAKER_\d+$"), F.lit(0.0)).otherwise(score)


def keyword_share(text: Column, keywords: Sequence[str]) -> Column:
    """Share of keywords that the text holds, regardless of case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hits = sum((F.when(F.contains(low, F.lit(k.lower())), 1).otherwise(0) for k in keywords), F.lit(0))
    return hits / F.lit(max(1, len(keywords)))


def term_frequency(text: Column, terms: Sequence[str]) -> Column:
    """Occurrences of terms among the text's words, over the number of words."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"(?U)[^\w]+")
    return F.size(F.filter(words, lambda w: w.isin(*[t.lower() for t in terms]))) / F.greatest(F.size(words), F.lit(1))


def matches_all_terms(text: Column, terms: Sequence[str]) -> Column:
    words = F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"(?U)[^\w]+"))
    wanted = sorted({t.lower() for t in terms})
    return F.size(F.array_intersect(words, F.array(*map(F.lit, wanted)))) == len(wanted)


def cache_key(text: Column) -> Column:
    return F.md5(F.lower(F.trim(text)))


def short_hash(*parts: Column, length: int = 8) -> Column:
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, length)


def citations(text: Column) -> Column:
    """Numbers in citation marks such as [3], in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"\[(\d+)\]"), F.lit(1)), lambda x: x.cast("int"))


def iso_duration(text: Column) -> Column:
    """Seconds of PT#H#M#S; null where the text isn't one."""
    part = lambda unit: F.coalesce(F.regexp_extract(text, rf"(\d+){unit}", 1).try_cast("int"), F.lit(0))
    return F.when(text.rlike(r"^PT(\d+H)?(\d+M)?(\d+S)?$"), part("H") * 3600 + part("M") * 60 + part("S"))


def clock_duration(text: Column) -> Column:
    """Seconds of [[hh:]mm:]ss; null where the text isn't one."""
    parts = F.transform(F.split(text, ":"), lambda x: x.try_cast("int"))
    seconds = F.aggregate(parts, F.lit(0), lambda acc, x: acc * 60 + x)
    return F.when(text.rlike(r"^\d+(:\d{1,2}){0,2}$"), seconds)


def version_parts(version: Column) -> Column:
    """(major, minor) of stitch_vN[.m]; null where the text isn't one."""
    at = lambda i: F.regexp_extract(version, r"^stitch_v(\d+)(?:\.(\d+))?$", i).try_cast("int")
    return F.when(at(1).isNotNull(), F.struct(at(1).alias("major"), F.coalesce(at(2), F.lit(0)).alias("minor")))


def thumbnail_url(content_id: Column, platform: Column, channel_key: Column, has_image: Column) -> Column:
    return (
        F.when(platform == "youtube", F.concat(F.lit("https://i.ytimg.com/vi/"), F.regexp_replace(content_id, "^yt_", ""), F.lit("/mqdefault.jpg")))
        .when(has_image, F.concat(F.lit("/channel-images/"), channel_key))
    )


def join_tokens(tokens: Column) -> Column:
    """Joins tokens with spaces, none before closing punctuation or after an opening one."""
    spaced = F.array_join(tokens, " ")
    return F.regexp_replace(F.regexp_replace(spaced, r" +([.,!?;:%)\]}])", "$1"), r"([(\[{]) +", "$1")
