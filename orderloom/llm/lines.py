"""Near-duplicate lines by a deletion-neighbourhood join; built-in functions only.

Two lines within one edit differ inside one short stretch and agree around it. So a
line's variants are first made by deleting whole stretches: halves, then eighths of the
half that is left, and so on. Only lines that share such a variant with another line go
on, with the stretch that was deleted. Once that is a dozen characters, all variants with
one character deleted are made; equal variants name the neighbours. No pair of lines is
made at any step: a group of equal variants is reduced to its earliest line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.stages import attach, discard, likely, stage

#: Lines shorter than this are duplicates only of equal lines; from here on within one edit.
NEAR_CHARS = 20
EDITS = 1
#: Stretches up to this length are taken apart character by character.
_SHORT = 12
_PARTS = 8
_ID = ["h1", "h2"]
_LINES = 1 << 31
_LAST_ID = (1 << 63) - 1


def normalised(line: Column) -> Column:
    """A line with runs of ASCII white space as one space, none at the ends; most lines have no such run."""
    runs = line.rlike(r"[\x09-\x0D]|\x20\x20")
    return F.trim(F.when(runs, F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")).otherwise(line))


def split_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line_no, at, norm) of every line that has a word; ``at`` orders all lines."""
    rows = docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line_no", "line"))
    at = F.coalesce(F.col("id"), F.lit(_LAST_ID)).cast("decimal(20,0)") * F.lit(_LINES).cast("decimal(10,0)") + F.col("line_no")
    return rows.select("id", "line_no", at.cast("decimal(38,0)").alias("at"), normalised(F.col("line")).alias("norm")).where("norm <> ''")


def _without(rest: Column, extra: Column, part: Column, parts: int) -> tuple[Column, Column, Column]:
    """(text before, stretch, text after) of one of ``parts`` stretches.

    Stretches are cut in the length that a line shares with partners: its own, or one
    less for a line that takes the longer place in a pair (``extra`` is 1); then the
    stretch is one longer and the text around it stays the same.
    """
    shared = F.length(rest) - extra
    low = F.floor(shared * part / parts).cast("int")
    high = F.floor(shared * (part + 1) / parts).cast("int") + extra
    return F.substring(rest, F.lit(1), low), F.substring(rest, low + 1, high - low), F.substring(rest, high + 1, F.length(rest))


def _shared(rows: DataFrame) -> DataFrame:
    """Rows whose variant occurs twice or more."""
    common = rows.groupBy("variant").agg(F.count("*").alias("n")).where("n > 1").select("variant")
    return rows.join(common, "variant", "left_semi")


def near_lines(lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """(h1, h2, near) for distinct lines with an earlier line within one edit: the earliest one's place.

    ``distinct`` has one row per different line: h1, h2, first (its earliest place), and
    the four half variants v0 .. v3.
    """
    halves = distinct.select(*_ID, "first", F.posexplode(F.array("v0", "v1", "v2", "v3")).alias("which", "variant")).where("variant is not null")
    halves = stage(_shared(halves), "halves")
    wanted = halves.select(*_ID, F.col("first").alias("at")).distinct()
    # An inner join: Spark would move a semi join below the filter.
    texts = stage(likely(lines, wanted, "h1").join(wanted, [*_ID, "at"]).dropDuplicates(_ID), "texts").select(*_ID, F.col("at").alias("first"), "norm")

    extra, part = F.floor(F.col("which") / 2).cast("int"), F.col("which") % 2
    _, stretch, _ = _without(F.col("norm"), extra, part, 2)
    state = stage(
        halves.drop("first").join(texts, _ID).select(*_ID, "first", extra.alias("extra"), "variant", stretch.alias("rest")), "stretch"
    )
    while (state.agg(F.max(F.length("rest") - F.col("extra"))).first()[0] or 0) > _SHORT:
        long = F.length("rest") - F.col("extra") > _SHORT
        before, inner, after = _without(F.col("rest"), F.col("extra"), F.col("part"), _PARTS)
        smaller = state.where(long).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1)))).select(
            *_ID, "first", "extra", F.xxhash64("variant", "part", before, after).alias("variant"), inner.alias("rest")
        )
        old, state = state, stage(_shared(stage(smaller, "smaller")).select(*state.columns).union(state.where(~long)), "stretch")
        discard(old)

    # Deleting one character: at the same place for a substitution, anywhere in the longer line for an insertion.
    cut = lambda p: F.concat(F.substring(F.col("rest"), F.lit(1), p - 1), F.substring(F.col("rest"), p + 1, F.length("rest")))
    places = F.when(F.length("rest") > 0, F.sequence(F.lit(1), F.length("rest"))).otherwise(F.array().cast("array<int>"))
    shorter = F.concat(
        F.array(F.struct(F.lit(0).alias("place"), F.col("rest").alias("left"))),
        F.transform(places, lambda p: F.struct(p.alias("place"), cut(p).alias("left"))),
    )
    longer = F.transform(places, lambda p: F.struct(F.lit(0).alias("place"), cut(p).alias("left")))
    made = state.withColumn("v", F.explode(F.when(F.col("extra") == 0, shorter).otherwise(longer))).select(
        *_ID, "first", "extra", (F.col("v.place") == 0).alias("inserted"), F.xxhash64("variant", "v.place", "v.left").alias("variant")
    )
    made = stage(made.distinct(), "variants")
    earliest = made.groupBy("variant", "inserted").agg(
        F.min("first").alias("any"), F.min(F.when(F.col("extra") == 0, F.col("first"))).alias("short"),
        F.min(F.when(F.col("extra") == 1, F.col("first"))).alias("long"), F.count("*").alias("n"),
    ).where("n > 1")
    partner = F.when(~F.col("inserted"), F.col("any")).when(F.col("extra") == 0, F.col("long")).otherwise(F.col("short"))
    # All partners, not just the earliest: each is verified below.
    found = made.join(earliest, ["variant", "inserted"]).withColumn("near", partner).where("near < first").select(*_ID, "near").distinct()
    own = found.join(texts.select(*_ID, F.col("norm").alias("own")), _ID)
    other = texts.select(F.col("first").alias("near"), F.col("norm").alias("other"))
    apart = F.levenshtein("own", "other", EDITS)
    return own.join(other, "near").where(apart.between(0, EDITS)).groupBy(*_ID).agg(F.min("near").alias("near"))


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_chars: int = NEAR_CHARS) -> DataFrame:
    """(id, line_no, keep_id, keep_line_no) of every line that goes, and the line it repeats.

    Lines are compared with white space collapsed; lines without a word are never
    duplicates. Places are ordered by document id (null last), then line number from 0. A
    line goes if an earlier one equals it, or is within one edit and both have
    ``near_chars`` characters or more. The earliest such line is named, whether it stays
    or goes itself. A null text has no lines; of documents that share an id, equal lines
    at an equal place count as one place.
    """
    lines = split_lines(docs, id_col, text_col).withColumn("h1", F.xxhash64("norm")).withColumn("h2", F.xxhash64(F.lit(1), "norm"))
    size = F.length("norm")

    def half(extra: int, part: int) -> Column:
        before, _, after = _without(F.col("norm"), F.lit(extra), F.lit(part), 2)
        return F.when(size - extra >= near_chars, F.xxhash64(size - extra, F.lit(part), before, after))

    # One pass over the texts makes the places of all lines and their hashes.
    halves = [half(e, p).alias(f"v{2 * e + p}") for e in (0, 1) for p in (0, 1)]
    places = stage(lines.select("id", "line_no", "at", *_ID, *halves), "places")
    distinct = stage(
        places.groupBy(*_ID).agg(F.min("at").alias("first"), F.count("*").alias("n"), *[F.max(f"v{i}").alias(f"v{i}") for i in range(4)]), "lines"
    )
    near = near_lines(lines, distinct)
    groups = stage(
        distinct.join(near, _ID, "left").where("n > 1 or near is not null").select(*_ID, "first", "n", F.least("first", "near").alias("keep")), "groups"
    )
    gone = attach(places.select("id", "line_no", "at", *_ID), groups, _ID, "n").where("at > keep")
    unit = F.lit(_LINES).cast("decimal(10,0)")
    keep_line = F.pmod(F.col("keep"), unit)
    keep_id = ((F.col("keep") - keep_line) / unit).cast("decimal(20,0)").cast("bigint")
    return gone.select(
        F.col("id").alias(id_col), "line_no", F.when(keep_id != _LAST_ID, keep_id).alias("keep_id"), keep_line.cast("int").alias("keep_line_no")
    )


def without_lines(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines in ``gone`` taken out of their texts; null texts stay null."""
    listed = gone.groupBy(F.col(id_col).alias("gone_id")).agg(F.collect_set("line_no").alias("gone_lines"))
    left = F.filter(
        F.transform(F.split(F.col(text_col), "\n"), lambda line, i: F.when(~F.coalesce(F.array_contains("gone_lines", i), F.lit(False)), line)),
        lambda line: line.isNotNull(),
    )
    own = [c for c in docs.columns]
    joined = docs.join(listed, docs[id_col].eqNullSafe(listed["gone_id"]), "left")
    return joined.withColumn(text_col, F.when(F.col("gone_lines").isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))).select(*own)
