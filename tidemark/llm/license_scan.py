"""Licence notices in texts: MinHash bands retrieve templates, shingle containment verifies.

Words are runs of a-z and 0-9 in lower case, shingles three of them. A text is read in
overlapping windows; for templates of up to ``c`` words a window has ``c + s - 1`` words
and a new one begins every ``s = c // 2`` words, so every occurrence lies inside a window
whole. A template of more than ``c / 2`` words then makes up at least a third of its
window, and one of ``BANDS`` bands of one MinHash value each agrees with a probability of
at least ``1 - (1 - 1/4) ** 48 > 0.999998``. A window that shares a band with a template is
kept when at least ``contained`` of the template's shingles are in it.

Two sets have a MinHash value in common only through a shingle they share, the one that
has the value. So a window can agree with a template in some band only where it holds one
of the template's band-minimal shingles, and values are computed for just those windows;
the result is that of computing them for all. Only DataFrame functions are used, texts
stay in their rows, and what is joined is the list of templates, which is part of the code.

Notices of sibling licences hold most of each other's shingles. A match lies where the
most of its template's shingles stand in about the template's order: their shifts against it
differ by at most a quarter of its size. Two matches of a text are at one
place when they share at least half of the positions of the one with fewer. There the match
whose shingles found exceed those missing by more wins over one of another licence; if equal,
the one with the better containment. Matches that are equal in both are all kept.

A null text, or one of fewer than three words, has no notice. Notices of repeated rows of
one ``doc_id`` count for each of them, and null is an id like any other. Texts are read whole, however long; an empty table gives
no rows; other columns than doc_id and text are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (licence, text of a notice).
Template = tuple[str, str]
WIDTH, BANDS = 3, 48
#: Positions of a cell. Matches at one place share a cell, and few windows touch a cell.
CELL = 64
_CLASSES = [6 * 2**k for k in range(12)]


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once, however often and wherever ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), 0)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    last = F.size(words) - WIDTH
    spots = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.transform(spots, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WIDTH))))


def band_values(shingles: Column) -> Column:
    """One MinHash value for each band."""

    def band(number: int) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(number))))

    return F.array(*map(band, range(BANDS)))


def _templates(docs: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """(number, license, scale, template, bands) of every template of three words or more."""
    spark = docs.sparkSession
    scale = F.lit(_CLASSES[-1])
    for c in reversed(_CLASSES[:-1]):
        scale = F.when(F.col("n_words") <= c, F.lit(c)).otherwise(scale)
    numbered = [(i, *t) for i, t in enumerate(templates)]
    words = spark.createDataFrame(numbered, "number int, license string, text string").select(
        "number", "license", words_of(F.col("text")).alias("words")
    )
    return (
        words.withColumn("n_words", F.size("words"))
        .where(F.col("n_words") >= WIDTH)
        .select("number", "license", scale.alias("scale"), F.array_distinct(let(F.col("words"), shingles_of)).alias("template"))
        .withColumn("bands", let(F.col("template"), band_values))
    )


def _unbeaten(matches: DataFrame) -> DataFrame:
    """The matches that no better one of another licence beats at the same place of a text."""
    match = F.struct("license", "first_word", "containment", "lead", "at")
    cells = F.array_distinct(F.transform("at", lambda p: F.floor(p / F.lit(CELL))))

    def beats(y: Column, x: Column) -> Column:
        better = (y["lead"] > x["lead"]) | ((y["lead"] == x["lead"]) & (y["containment"] > x["containment"]))
        shared = 2 * F.size(F.array_intersect(x["at"], y["at"])) >= F.least(F.size(x["at"]), F.size(y["at"]))
        return (y["license"] != x["license"]) & better & shared

    return (
        matches.select("doc_id", "print", match.alias("match"), F.explode(cells).alias("cell"))
        .groupBy("doc_id", "print", "cell")
        .agg(F.collect_set("match").alias("all"))
        .select("doc_id", "print", "all", F.explode("all").alias("match"))
        .withColumn("beaten", F.exists("all", lambda y: beats(y, F.col("match"))))
        .groupBy("doc_id", "print", "match")
        .agg(F.bool_or("beaten").alias("beaten"))
        .where(~F.col("beaten"))
        .select("doc_id", "match.*")
    )


def find_licenses(docs: DataFrame, templates: Sequence[Template], contained: float = 0.8) -> DataFrame:
    """doc_id, license, first_word, containment: the best window of each licence in each document."""
    known = _templates(docs, templates)
    scales = sorted(r["scale"] for r in known.select("scale").distinct().collect())
    # Of each template and band, the shingle whose value is the least.
    hashed = known.select("bands", F.explode("template").alias("shingle"))
    values = F.array(*(F.xxhash64("shingle", F.lit(b)) for b in range(BANDS)))
    anchors = [
        r["shingle"]
        for r in hashed.where(F.exists(F.zip_with(values, "bands", lambda a, b: a == b), lambda x: x))
        .select("shingle")
        .distinct()
        .collect()
    ]
    bands = known.select("number", "license", "scale", "template", F.posexplode("bands").alias("band", "value"))

    def spotted(shingles: Column) -> Column:
        spots = F.array_compact(F.transform(shingles, lambda h, i: F.when(h.isin(anchors), i)))
        return F.struct(shingles.alias("shingles"), spots.alias("spots"))

    # A generator is not merged with what stands above it, so a text is split once.
    text = words_of(F.col("text").cast("string"))
    once = F.array(let(text, lambda w: let(shingles_of(w), spotted)))
    # Rows of one doc_id are told apart by their text, so their matches do not compete.
    held = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("print"), F.inline(once))
    held = held.where(F.size("spots") > 0)
    if not scales:
        raise ValueError("no template of three words or more")
    places = []
    for scale in scales:
        step = scale // 2
        width = scale + step - 1 - (WIDTH - 1)  # shingles of a window

        def around(spot: Column, width: int = width, step: int = step) -> Column:
            """Window k begins at shingle k * step; the windows that hold the shingle at ``spot``."""
            first = F.greatest(F.lit(0), F.ceil((spot - width + 1) / F.lit(step)).cast("int"))
            return F.sequence(first, F.floor(spot / F.lit(step)).cast("int"))

        def place(k: Column, scale: int = scale, width: int = width, step: int = step) -> Column:
            return F.struct(F.lit(scale).alias("scale"), (k * step).alias("first_word"), F.lit(width).alias("width"))

        held_by = F.array_distinct(F.flatten(F.transform("spots", lambda spot: around(spot))))
        places.append(F.transform(held_by, lambda k: place(k)))
    windows = held.select("doc_id", "print", "shingles", F.inline(F.concat(*places))).select(
        "doc_id",
        "print",
        "scale",
        F.col("first_word").cast("long").alias("first_word"),
        F.slice("shingles", F.col("first_word") + 1, F.col("width")).alias("window"),
    )
    keyed = windows.select("doc_id", "print", "scale", "first_word", "window", F.posexplode(let(F.col("window"), band_values)).alias("band", "value"))
    near = keyed.join(F.broadcast(bands), ["scale", "band", "value"])
    shared, whole = F.size(F.array_intersect("window", "template")), F.size("template")
    hits = F.array_compact(
        F.transform(
            "window",
            lambda h, i: F.when(
                F.array_contains("template", h),
                F.struct(
                    (F.col("first_word") + i - F.array_position("template", h)).alias("shift"),
                    (F.col("first_word") + i).alias("p"),
                    h.alias("h"),
                ),
            ),
        )
    )
    slack = F.floor(whole / F.lit(4))

    def lies(hits: Column) -> Column:
        """(found, at): the shifts with the most of the template's shingles, the least of several."""
        near_by = lambda s: F.filter(hits, lambda x: x["shift"].between(s["shift"], s["shift"] + slack))
        counted = F.transform(
            hits,
            lambda s: let(
                near_by(s),
                lambda x: F.struct(F.size(F.array_distinct(x["h"])).alias("found"), (-s["shift"]).alias("n"), x["p"].alias("at")),
            ),
        )
        return F.array_max(counted)

    matches = (
        near.withColumn("containment", shared / whole)
        .where(F.col("containment") >= contained)
        .dropDuplicates(["doc_id", "print", "first_word", "number"])
        .withColumn("lies", let(hits, lies))
        .select(
            "doc_id", "print", "license", "first_word", "containment", (2 * F.col("lies.found") - whole).alias("lead"), "lies.at"
        )
    )
    return (
        _unbeaten(matches)
        .groupBy("doc_id", "license")
        .agg(
            F.max("containment").alias("containment"),
            F.max_by("first_word", F.struct("containment", -F.col("first_word"))).alias("first_word"),
        )
        .select("doc_id", "license", "first_word", "containment")
    )
