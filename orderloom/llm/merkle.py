"""Merkle manifest of a dataset, and per-leaf proofs by a recursive query."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.llm.ascii import ascii_lower
from orderloom.llm.stages import discard, stage
from orderloom.operators.ranks import numbered

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes above one leaf in this many or more are broadcast: per level there are at most so many.
HEAVY_SHARE = 4096
#: The tree whose leaves are the subroots.
TOP = -1


def framed(value: Column) -> Column:
    """A field as hashed: ``-`` for null, else its bytes in UTF-8 counted, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[framed(f) for f in fields]), 256)


def _raised(nodes: DataFrame, fanout: int) -> DataFrame:
    """The level above (tree, level, idx, n, weight, digest): every run of ``fanout`` nodes becomes one."""
    runs = nodes.groupBy("tree", "level", F.floor(F.col("idx") / fanout).alias("run"), "n").agg(
        F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("of"), F.sum("weight").alias("weight")
    )
    joined = F.array_join(F.transform("of", lambda c: c["digest"]), "")
    return runs.select(
        "tree", (F.col("level") + 1).alias("level"), F.col("run").alias("idx"), F.ceil(F.col("n") / fanout).alias("n"), "weight",
        F.sha2(joined, 256).alias("digest"), F.unhex(joined).alias("children"),
    )


def _levels(leaves: DataFrame, fanout: int, label: str) -> list[DataFrame]:
    """Stage tables of a forest's levels above ``leaves``, up to one node a tree."""
    out, below = [], leaves
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        below = stage(_raised(below.where("n > 1"), fanout), label)
        out.append(below)
        most = -(-most // fanout)
    return out


_NODE = ("tree", "level", "idx", "n", "weight", "digest")


def _linked(nodes: DataFrame, langs: int, fanout: int) -> DataFrame:
    """Nodes with the key of their parent and their place below it; the root has none.

    A subroot, the last node of its tree, is a leaf of the top tree.
    """
    single = F.col("n") == 1
    up = single & (F.col("tree") != TOP) & F.lit(langs > 1)
    inside = ~single
    own = lambda of_tree, of_top: F.when(inside, of_tree).when(up, of_top)
    return nodes.select(
        "*",
        own(F.col("tree"), F.lit(TOP).cast("bigint")).alias("parent_tree"),
        own(F.col("level") + 1, F.lit(1)).cast("int").alias("parent_level"),
        own(F.floor(F.col("idx") / fanout), F.floor(F.col("tree") / fanout)).cast("bigint").alias("parent_idx"),
        own(F.col("idx") % fanout, F.col("tree") % fanout).cast("int").alias("place"),
        (single & (F.col("tree") != TOP)).alias("is_subroot"),
    )


_CLIMB = """
WITH RECURSIVE climb AS (
    SELECT tree, idx, step, parent_tree, parent_level, parent_idx, place, folded, siblings, subroot FROM {start}
    UNION ALL
    SELECT c.tree, c.idx, c.step + 1, n.parent_tree, n.parent_level, n.parent_idx, n.place,
           unhex(sha2(lower(hex(concat(substring(n.children, 1, 32 * c.place), c.folded, substring(n.children, 32 * c.place + 33)))), 256)),
           concat(substring(n.children, 1, 32 * c.place), substring(n.children, 32 * c.place + 33)),
           CASE WHEN n.is_subroot THEN unhex(n.digest) END
    FROM climb AS c JOIN {nodes} AS n
      ON c.parent_tree = n.tree AND c.parent_level = n.level AND c.parent_idx = n.idx
)
SELECT * FROM climb
"""
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"
_AT = ("parent_tree", "parent_level", "parent_idx", "place", "folded")


def ascend(start: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every step of every leaf from ``start`` up through ``nodes``; to be used in ``unlimited``.

    One row a step: the siblings met there, in order, the hash folded so far, and the
    digest of a subroot that was reached. The rows of ``start`` come as well, without
    siblings. The query stops by itself where no leaf finds a parent in ``nodes``.
    """
    return start.sparkSession.sql(_CLIMB, start=start, nodes=nodes)


@contextmanager
def unlimited(spark: SparkSession) -> Iterator[None]:
    """Jobs in this block run recursive queries of any number of rows."""
    before = spark.conf.get(_ROW_LIMIT, None)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.unset(_ROW_LIMIT) if before is None else spark.conf.set(_ROW_LIMIT, before)


def manifest(rows: DataFrame, group_col: str, order: Sequence[Column], fanout: int = FANOUT) -> tuple[DataFrame, list[DataFrame], int, str | None]:
    """(leaves, stored levels, number of groups, root) of rows with a column ``leaf``.

    Leaves are the rows with tree (their group's place, nulls first), idx and n (the
    group's size). Leaves get their places by range sort and prefix sums, and every level
    is one shuffle of runs of ``fanout`` nodes, so a group with all rows is spread like
    any other. Only the root's digest and the number of groups come to the driver.
    """
    placed = numbered(rows, order, "idx", within=group_col, group="tree", total="n")
    leaves = stage(placed.withColumns({"level": F.lit(0), "weight": F.lit(1).cast("bigint"), "digest": F.col("leaf")}), "leaves")
    levels = _levels(leaves.select(*_NODE), fanout, "nodes")
    subroots = leaves.where("n = 1").select(*_NODE)
    for level in levels:
        subroots = subroots.unionByName(level.where("n = 1").select(*_NODE))
    counted = subroots.agg(F.count("*"), F.max("digest")).first()
    groups, root = counted[0], counted[1]
    top = subroots.select(
        F.lit(TOP).cast("bigint").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"),
        F.lit(groups).cast("bigint").alias("n"), "weight", "digest",
    )
    if groups > 1:
        above = _levels(stage(top, "subroots"), fanout, "top")
        root = above[-1].first()["digest"]
        levels = levels + above
    return leaves, levels, groups, root


def proofs(
    rows: DataFrame, group_col: str, order: Sequence[Column], keep: Sequence[str], fanout: int = FANOUT, heavy_share: int = HEAVY_SHARE
) -> DataFrame:
    """``keep`` and leaf, subroot, root, proof_sha256, folded_root, verified for every row.

    ``rows`` has leaf and tampered, the hash to be folded. Each leaf climbs alone in a
    recursive query over the parent-linked node rows: it appends the siblings of its run
    and folds its hash among them. Below nodes with few leaves the join is a shuffle in
    which a key has at most that many rows; nodes that stand above one leaf in
    ``heavy_share`` or more are at most that many a level, and the second half of the
    climb joins a broadcast of them. Equal rows are leaves of their own. An empty table has
    no rows; a lone leaf is its subroot, a lone subroot the root, and without siblings the
    proof is the hash of nothing.
    """
    leaves, levels, groups, root = manifest(rows, group_col, order, fanout)
    if not groups:
        empty = leaves.select(*keep, "leaf")
        return empty.select("*", *[F.lit("").alias(c) for c in ("subroot", "root", "proof_sha256", "folded_root")], F.lit(True).alias("verified"))
    start = _linked(leaves, groups, fanout).select(
        "tree", "idx", F.lit(0).alias("step"), *_AT[:4], F.unhex("tampered").alias("folded"),
        F.lit(None).cast("binary").alias("siblings"), F.lit(None).cast("binary").alias("subroot"),
    )
    nodes = leaves.where("false").select(*_NODE, F.lit(None).cast("binary").alias("children"))
    for level in levels:
        nodes = nodes.unionByName(level)
    linked = stage(_linked(nodes, groups, fanout), "linked")
    count = leaves.agg(F.sum("weight")).first()[0]
    heavy = F.col("weight") * heavy_share >= count
    with unlimited(leaves.sparkSession):
        # Light nodes are no bounded table, so they are not left to a guess of their size.
        lower = stage(ascend(start, linked.where(~heavy).hint("merge")), "climb")
        last = lower.groupBy("tree", "idx").agg(F.max(F.struct("step", *_AT)).alias("at")).select("tree", "idx", "at.*")
        onward = stage(last.select("*", F.lit(None).cast("binary").alias("siblings"), F.lit(None).cast("binary").alias("subroot")), "onward")
        steps = lower.unionByName(ascend(onward, F.broadcast(linked.where(heavy)))).where("siblings IS NOT NULL")
        folded = stage(
            # Steps of a leaf come from different tasks, so there is nothing to combine ahead of the shuffle.
            steps.repartition("tree", "idx").groupBy("tree", "idx").agg(
                F.array_sort(F.collect_list(F.struct("step", "siblings"))).alias("steps"),
                F.max(F.struct("step", "folded"))["folded"].alias("folded"), F.max("subroot").alias("subroot"),
            ).select(
                "tree", "idx", F.lower(F.hex("subroot")).alias("subroot"), F.lower(F.hex("folded")).alias("folded_root"),
                F.sha2(F.array_join(F.transform("steps", lambda s: F.lower(F.hex(s["siblings"]))), ""), 256).alias("proof_sha256"),
            ), "proofs",
        )
    for table in (lower, onward):
        discard(table)
    own = leaves.select(*keep, "leaf", "tampered", "tree", "idx").join(folded.hint("merge"), ["tree", "idx"], "left")
    reached = F.coalesce("folded_root", "tampered")
    return own.select(
        *keep, "leaf", F.coalesce("subroot", "leaf").alias("subroot"), F.lit(root).alias("root"),
        F.coalesce("proof_sha256", F.sha2(F.lit(""), 256)).alias("proof_sha256"), reached.alias("folded_root"), (reached == F.lit(root)).alias("verified"),
    )


def document_rows(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", text_col: str = "text", every: int = 3) -> DataFrame:
    """(id, lang, leaf, tampered): a leaf per document, and its hash after tampering.

    Where ``every`` divides the CRC-32 of the decimal id, tampering lower-cases A-Z in the
    text; a null id or text stays.
    """
    own = [F.col(c) for c in fields]
    changed = [ascii_lower(F.col(c)) if c == text_col else F.col(c) for c in fields]
    hit = F.coalesce(F.crc32(F.col(id_col).cast("string")) % every == 0, F.lit(False))
    leaf = leaf_hash(own)
    return docs.select(
        F.col(id_col).alias("id"), F.col("lang").alias("group"), leaf.alias("leaf"),
        F.when(hit, leaf_hash(changed)).otherwise(leaf).alias("tampered"),
    )


def document_manifest(docs: DataFrame, fanout: int = FANOUT, heavy_share: int = HEAVY_SHARE) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of ``docs``.

    Leaves go by lang, null first, then by doc_id (null first), then by hash. Columns
    other than the hashed ones are not read. Long texts are hashed in their scan task and
    not moved.
    """
    rows = stage(document_rows(docs), "hashed")
    found = proofs(rows, "group", [F.asc_nulls_first("id"), F.col("leaf")], ["id"], fanout, heavy_share)
    return found.withColumnRenamed("id", "doc_id")
