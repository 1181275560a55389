"""Merkle manifest of a table: leaf, subroot and root hashes, and a proof for every row.

Rows of a source form a tree of runs of 16 in the order of their id, the subroots of all
sources form one more. Nodes above the leaves hold the siblings of one step and the
ancestor it leads to. Joining this table with itself doubles the step: the segments of
both are concatenated and the ancestor of the ancestor takes its place, until every node
has reached the root. All leaves of a run share the way of the run's parent, so a leaf
adds its own siblings at the last join. Nothing but tree sizes reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkyield.functions.ordered import POS, positioned
from sparkyield.llm.common import checkpointed
from sparkyield.runtime import attach

FAN = 16
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: the tree of sources has this number in place of a source's
TOP = -1
PATH = "array<struct<before:binary,after:binary>>"


def encoded(value: Column) -> Column:
    """``-`` for null, else byte count, colon and the value."""
    text = value.cast("string")
    size = F.octet_length(text).cast("string")
    return F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in columns]), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _node(digests: Column) -> Column:
    """The parent of digests in binary form."""
    return F.unhex(F.sha2(_hex(digests), 256))


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.unhex(F.lit("")), lambda a, d: F.concat(a, d))


def _step(run: Column, place: Column) -> Column:
    """What stands before and after ``place`` in a run of digests."""
    before = F.slice(run, F.lit(1), place)
    after = F.slice(run, place + 2, F.lit(FAN))
    return F.struct(_joined(before).alias("before"), _joined(after).alias("after"))


def _runs(nodes: DataFrame, carried: list[str] = ()) -> DataFrame:
    """Runs of 16 of ``nodes (g, i, n, digest)``: parent place, digests in order, parent's size."""
    place = F.shiftright("i", 4).alias("i")
    n = F.ceil(F.col("n") / FAN).alias("n")
    run = F.array_sort(F.collect_list(F.struct("i", "digest", *carried))).alias("run")
    return nodes.where("n > 1").groupBy("g", place, n).agg(run)


def _climb(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Runs of every level above ``nodes``, and the last node of each tree."""
    runs, tops = [], nodes.where("n = 1")
    for _ in range(levels):
        level = checkpointed(_runs(nodes))
        runs.append(level)
        digest = _node(_joined(F.transform("run", lambda r: r["digest"])))
        nodes = level.select("g", "i", "n", digest.alias("digest"))
        tops = tops.unionByName(nodes.where("n = 1"))
    return runs, checkpointed(tops.select("g", "digest"))


def _levels(n: int) -> int:
    """Runs between the rows of a tree and its last node."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out


def _links(runs: list[DataFrame], first: int) -> list[DataFrame]:
    """One step of every node below a run, from level ``first`` of the tree.

    ``(g, l, i)`` is the node, ``(ag, al, ai)`` its parent. The last node of a source
    is the node of that source in the tree of sources.
    """
    out = []
    for level, run in enumerate(runs):
        if level < first:
            continue
        each = run.select(
            "g", F.col("i").alias("ai"), "n", F.posexplode("run").alias("place", "one"), "run"
        )
        step = _step(F.transform("run", lambda r: r["digest"]), F.col("place"))
        above = F.when((F.col("n") == 1) & (F.col("g") >= 0), True).otherwise(False)
        out.append(
            each.select(
                "g",
                F.lit(level).alias("l"),
                F.col("one.i").alias("i"),
                F.when(above, F.lit(TOP)).otherwise(F.col("g")).alias("ag"),
                F.when(above, F.lit(0)).otherwise(F.lit(level + 1)).alias("al"),
                F.when(above, F.col("g")).otherwise(F.col("ai")).alias("ai"),
                F.array(step).cast(PATH).alias("path"),
            )
        )
    return out


def _to_root(links: DataFrame, height: int, top: int) -> DataFrame:
    """Ways ``(g, l, i, path)`` to the root, by joins that double the length of a step.

    ``top`` is the level of the root in the tree of sources. Nodes that have arrived
    leave the joins, so the root is never a join key.
    """
    arrived = (F.col("ag") == TOP) & (F.col("al") == top)
    now, reach = checkpointed(links), 1
    while reach < height:
        going, done = now.where(~arrived), now.where(arrived)
        on = now.select(
            F.col("g").alias("ag"),
            F.col("l").alias("al"),
            F.col("i").alias("ai"),
            F.struct("ag", "al", "ai", "path").alias("next"),
        )
        further = going.join(on, ["ag", "al", "ai"]).select(
            "g", "l", "i", "next.ag", "next.al", "next.ai",
            F.concat("path", F.col("next.path")).alias("path"),
        )
        now, reach = checkpointed(further.unionByName(done)), 2 * reach
    return now.select("g", "l", "i", "path")


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Leaf, subroot, root, proof and verification of every row of ``docs``.

    The columns ``doc_id, source, lang, n_chars, text`` make a leaf; others are ignored.
    ``tampered`` is the text to verify with in place of the row's own. A null in any of
    them is a value of its own: a null id comes first in its source and a null source
    before the others. Rows with equal ids are ordered by leaf and each keeps a row of
    its own; equal rows have equal leaves and differ in their proofs. An empty table
    gives no rows.
    """
    values = [F.col(c) for c in FIELDS]
    other = F.col("text") if tampered is None else tampered
    leaves = checkpointed(
        docs.select(
            F.col("doc_id"),
            F.col("source"),
            F.unhex(leaf_hash(values)).alias("digest"),
            F.unhex(leaf_hash([*values[:-1], other])).alias("tried"),
        )
    )
    placed = positioned(leaves, ["source", "doc_id", "digest", "tried"])
    sizes = checkpointed(leaves.groupBy("source").agg(F.count("*").alias("n")))
    ranked = checkpointed(positioned(sizes, ["source"]).withColumnRenamed(POS, "g"))
    most, sources = ranked.agg(F.max("n"), F.count("*")).first()
    before = ranked.alias("a").select("source", "n", "g")
    starts = positioned_starts(before)
    placed = attach(placed, starts, ["source"], check=True)
    nodes = placed.select(
        "g", (F.col(POS) - F.col("start")).alias("i"), "n", "digest", "tried", "doc_id"
    )
    ground = checkpointed(_runs_or_alone(nodes))
    inner, outer = _levels(most or 0), _levels(sources)

    first = ground.where("n > 0").select("g", "i", "n", "run")
    digest = _node(_joined(F.transform("run", lambda r: r["digest"])))
    above = first.select("g", "i", "n", digest.alias("digest"))
    alone = ground.where("n = 0").select("g", F.col("run")[0]["digest"].alias("digest"))
    runs, tops = _climb(above, max(0, inner - 1))
    subroots = checkpointed(tops.unionByName(alone))
    row = F.lit(sources).cast("long").alias("n")
    top_nodes = subroots.select(F.lit(TOP).cast("long").alias("g"), F.col("g").alias("i"), row, "digest")
    top_runs, root = _climb(top_nodes, outer)

    links = _links([None, *runs], 1) + _links(top_runs, 0)
    if links:
        table = links[0]
        for more in links[1:]:
            table = table.unionByName(more)
        ways = _to_root(table, max(0, inner - 1) + outer, outer)
    else:
        empty = "g long, l int, i long, path " + PATH
        ways = docs.sparkSession.createDataFrame([], empty)
    # where the way of a run's leaves goes on: the parent, or the source's node
    ends = F.col("n") <= 1
    joined = ground.select(
        F.when(ends, F.lit(TOP).cast("long")).otherwise(F.col("g")).alias("_g"),
        F.when(ends, F.lit(0)).otherwise(F.lit(1)).alias("_l"),
        F.when(ends, F.col("g")).otherwise(F.col("i")).alias("_i"),
        F.col("g").alias("source_no"), "n", "run",
    )
    ways = ways.select(F.col("g").alias("_g"), F.col("l").alias("_l"), F.col("i").alias("_i"), "path")
    joined = joined.join(ways, ["_g", "_l", "_i"], "left")
    named = subroots.select(F.col("g").alias("source_no"), F.col("digest").alias("subroot"))
    joined = attach(joined, named, ["source_no"], check=True)
    joined = attach(joined, root.select(F.col("digest").alias("root")), [])
    return _verified(joined)


def positioned_starts(sizes: DataFrame) -> DataFrame:
    """``(source, n, g)`` with ``start``, the rows of all sources before."""
    from sparkyield.functions.ordered import running_total

    total = running_total(sizes, [], ["g"], {"_upto": F.col("n")})
    return checkpointed(total.select("source", "n", "g", (F.col("_upto") - F.col("n")).alias("start")))


def _runs_or_alone(nodes: DataFrame) -> DataFrame:
    """Runs of leaves; a source's only leaf stands alone with ``n`` 0, for no hash is above it."""
    n = F.when(F.col("n") == 1, F.lit(0)).otherwise(F.ceil(F.col("n") / FAN)).cast("long").alias("n")
    run = F.array_sort(F.collect_list(F.struct("i", "digest", "tried", "doc_id"))).alias("run")
    return nodes.groupBy("g", F.shiftright("i", 4).alias("i"), n).agg(run)


def _verified(runs: DataFrame) -> DataFrame:
    """One row for each leaf of ``runs`` with its proof and the root folded from it."""
    each = runs.select("*", F.posexplode("run").alias("place", "one"))
    none = F.array().cast(PATH)
    own = F.array(_step(F.transform("run", lambda r: r["digest"]), F.col("place"))).cast(PATH)
    steps = F.concat(F.when(F.col("n") > 0, own).otherwise(none), F.coalesce("path", none))
    each = each.select(
        F.col("one.doc_id").alias("doc_id"),
        _hex(F.col("one.digest")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        _hex(F.col("root")).alias("root"),
        _hex(F.col("one.tried")).alias("tried"),
        steps.alias("steps"),
    )
    siblings = F.transform("steps", lambda s: F.concat(_hex(s["before"]), _hex(s["after"])))
    folded = F.aggregate(
        "steps",
        F.col("tried"),
        lambda a, s: F.sha2(F.concat(_hex(s["before"]), a, _hex(s["after"])), 256),
    )
    return each.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.concat_ws("", siblings), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        F.size("steps").alias("n_steps"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def audit(docs: DataFrame, every: int = 5) -> DataFrame:
    """:func:`manifest` with the text lower-cased where ``every`` divides crc32 of the id.

    A row with a null id is not tampered with.
    """
    marked = F.crc32(F.col("doc_id").cast("string")) % every == 0
    text = F.when(marked, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    return manifest(docs, text)
