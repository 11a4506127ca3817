"""A Merkle manifest of a table of documents, and proofs that need no other document.

Rows hash to leaves. The leaves of a source, in order, form runs of ``fan`` nodes; a run's hash is its parent,
level by level, until one node remains. The sources' nodes form a tree likewise. On each level a window over
a run gives every node its siblings: lag and lead columns of the fixed offsets up to ``fan`` - 1, masked by the
node's slot and the length of its run. The parent is the hash that the run's first child has of itself and its
leads. A level is a sixteenth of the one below, so a leaf's path comes from its run's parent by an equi-join.

Leaves get their place in their source by one range exchange, whose parts are written with their number: a
part's first place is the count of the parts before it. No source is ever in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.llm.common import written

FAN = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """A value as it enters a leaf: ``-`` for null, else UTF-8 byte count, colon, value."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*columns: Column) -> Column:
    return digest(*[field(c) for c in columns])


def folded_case(text: Column) -> Column:
    """The text with A-Z in lower case: the tampering of the contract."""
    return F.translate(text, _UPPER, _LOWER)


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``place`` (from 0) within their group in the given order (nulls first), and the group's
    ``size``. Rows that agree in all of ``order`` are in any order. The rows are read twice: they are to be a table."""
    parts = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = rows.repartitionByRange(int(parts), group, *order).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "ranged")
    counts = ranged.groupBy(group, "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col(group).alias("g"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                           F.sum("n").over(Window.partitionBy(group)).alias("size"))
    inside = F.row_number().over(Window.partitionBy(group, "part").orderBy(*order)) - 1
    joined = ranged.withColumn("inside", inside).join(counts, (F.col(group) == F.col("g")) & (F.col("part") == F.col("p")))
    return joined.withColumn("place", F.col("before") + F.col("inside")).drop("part", "inside", "g", "p", "before")


def _with_siblings(nodes: DataFrame, fan: int) -> DataFrame:
    """Nodes of groups that hold several, with the texts of the hashes before (``left``) and after (``right``) them
    in their run."""
    slot, run = F.col("place") % fan, F.floor(F.col("place") / fan).cast("long")
    length = F.least(F.lit(fan).cast("long"), F.col("size") - F.col("run") * fan)
    nodes = nodes.where(F.col("size") > 1).withColumn("slot", slot).withColumn("run", run).withColumn("length", length)
    window = Window.partitionBy("group", "run").orderBy("slot")
    for j in range(1, fan):
        nodes = nodes.withColumn(f"lag{j}", F.when(F.col("slot") >= j, F.lag("hash", j).over(window)))
        nodes = nodes.withColumn(f"lead{j}", F.when(F.col("slot") + j < F.col("length"), F.lead("hash", j).over(window)))
    left, right = F.concat_ws("", *[F.col(f"lag{j}") for j in range(fan - 1, 0, -1)]), F.concat_ws("", *[F.col(f"lead{j}") for j in range(1, fan)])
    nodes = nodes.withColumn("left", left).withColumn("right", right)
    return nodes.drop("length", *[f"{way}{j}" for j in range(1, fan) for way in ("lag", "lead")])


_PATH = "array<struct<left:string,right:string>>"


def tree(leaves: DataFrame, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """Roots (group, hash) and (group, run, path) of the lowest runs: the siblings' texts of all levels above them.

    ``leaves`` has group, place, size and hash, and is a table. Levels follow while a group has several nodes.
    """
    levels, nodes = [], leaves.select("group", "place", "size", "hash")
    roots = nodes.where(F.col("size") == 1).select("group", "hash")
    most = nodes.agg(F.max("size")).first()[0] or 1
    while most > 1:
        parents = _with_siblings(nodes, fan).where(F.col("slot") == 0).select(
            "group", F.col("run").alias("place"), F.ceil(F.col("size") / fan).cast("long").alias("size"), digest(F.col("hash"), F.col("right")).alias("hash"))
        nodes, most = written(parents, "nodes"), -(-most // fan)
        levels.append(nodes)
        roots = roots.unionByName(nodes.where(F.col("size") == 1).select("group", "hash"))
    paths = None
    for nodes in reversed(levels):
        above = nodes.where(F.col("size") == 1).select("group", F.col("place").alias("run"), F.array().cast(_PATH).alias("path"))
        if paths is not None:
            own = _with_siblings(nodes, fan).join(paths, ["group", "run"])
            above = above.unionByName(own.select("group", F.col("place").alias("run"), F.concat(F.array(F.struct("left", "right")), "path").alias("path")))
        paths = above
    if paths is None:
        paths = leaves.select("group", F.col("place").alias("run"), F.array().cast(_PATH).alias("path")).limit(0)
    return roots, paths


def fold(start: Column, path: str) -> Column:
    """The root that a node and its siblings' texts give."""
    return F.aggregate(path, start, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def manifest(docs: DataFrame, fan: int = FAN, tampered: Column | None = None) -> DataFrame:
    """(doc_id, source, leaf, claimed, subroot, root, path, proof_sha256, folded_root, verified): one row per row of ``docs``.

    ``path`` is the array of (left, right) from the leaf to the root, ``claimed`` the leaf of the row as it is found where ``tampered``
    holds (its text in lower case), else ``leaf``; ``folded_root`` is the root that ``claimed`` gives.

    A null source is a group and comes first; null ids come first in theirs; rows of one id are leaves of their own, in the
    order of their hashes. Nulls and empty texts hash differently. No rows give no rows. Columns other than doc_id, source,
    lang, n_chars and text are not read.
    """
    doc_id, source, lang, n_chars, text = (F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    whole = leaf(doc_id, source, lang, n_chars, text)
    changed = F.coalesce(tampered, F.lit(False)) & text.isNotNull() if tampered is not None else F.lit(False)
    claimed = F.when(changed, leaf(doc_id, source, lang, n_chars, folded_case(text)))
    key = F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))
    rows = written(docs.select("doc_id", "source", key.alias("group"), whole.alias("hash"), claimed.alias("claimed"),
                               F.monotonically_increasing_id().alias("row")), "leaves")
    leaves = written(placed(rows, "group", ["doc_id", "hash", "row"]), "placed")
    subroots, inner = tree(leaves, fan)
    subroots = written(subroots, "subroots")
    tops = written(placed(subroots.select(F.lit("").alias("group"), F.col("group").alias("key"), "hash"), "group", ["key"]), "tops")
    roots, upper = tree(tops, fan)
    upper = _paths(tops, upper, fan).select(F.col("key").alias("group"), F.col("hash").alias("subroot"), F.col("path").alias("upper"),
                                           F.col("group").alias("all"))
    upper = upper.join(F.broadcast(roots.select(F.col("group").alias("all"), F.col("hash").alias("root"))), "all").drop("all")  # one row
    found = _paths(leaves, inner, fan).join(upper, "group")
    found = found.withColumn("path", F.concat("path", "upper")).withColumn("leaf", F.col("hash")).withColumn("claimed", F.coalesce("claimed", "hash"))
    proof = F.sha2(F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), ""), 256)
    found = found.withColumn("proof_sha256", proof).withColumn("folded_root", fold(F.col("claimed"), "path"))
    return found.select("doc_id", "source", "leaf", "claimed", "subroot", "root", "path", "proof_sha256", "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


def _paths(leaves: DataFrame, paths: DataFrame, fan: int) -> DataFrame:
    """Leaves with their whole paths in their tree."""
    several = _with_siblings(leaves, fan).join(paths, ["group", "run"])
    several = several.withColumn("path", F.concat(F.array(F.struct("left", "right")), "path")).drop("left", "right", "slot", "run")
    alone = leaves.where(F.col("size") == 1).withColumn("path", F.array().cast(_PATH))
    return several.unionByName(alone)
