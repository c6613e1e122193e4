"""Join of texts whose n-gram sets overlap, by banded MinHash.

``band_plan`` chooses rows and bands for a target recall at the threshold. The
steps:

1. Each row gives the hash of its n-gram set and the hashes of its bands. Rows
   with one set form a node; only nodes are compared.
2. Bands are shuffled by their hash. In each bucket every node is linked to the
   least one, which joins the bucket's nodes without listing their pairs.
   Connected components of these links hold all candidates.
3. The full n-gram sets of each component's nodes are compared, all with all,
   inside tasks: a component is dealt to blocks of bounded size by a hash, and
   each pair of blocks is a task's group. A group returns, for each node, how many
   rows it is linked to and one link of a spanning forest; pairs are not rows.
4. Components of the verified links are the classes.

The work inside a component grows with the square of its different texts, as the
number of links does; its rows are sent once per block of their component.

Words are the runs of other characters than space and \\x09-\\x0D, unchanged. A
text of 1 to n - 1 words has one n-gram, all its words. Similarity is exact on
64-bit hashes of n-grams.

Nulls: a null text, like one without words, is similar to nothing and forms a
class of its own; rows with a null id are not compared and get a null class_id and
no links. Repeated rows are copies of each other. Ties go to the least id. Long
texts are taken whole. An empty table gives an empty result. Further columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    gram_hashes,
    in_order,
    long_column,
    map_steps,
    raw_texts,
    word_hashes,
    words_of,
    written,
)
from .components import star_components

N_GRAM = 5
#: Similarity of 4/5 or more, as whole numbers, so that no rounding decides.
THRESHOLD = (4, 5)
RECALL = 0.99999
MAX_HASHES = 160
#: N-grams of a block of a component that is verified at a time.
BLOCK_GRAMS = 100_000


def band_plan(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """Rows and bands: as many rows as reach the recall with so many hashes."""
    best = None
    for rows in range(1, max_hashes + 1):
        miss = 1 - threshold**rows
        bands = 1 if miss <= 0 else math.ceil(math.log(1 - recall) / math.log(miss))
        if rows * bands > max_hashes:
            break
        best = rows, max(1, bands)
    if best is None:
        raise ValueError("the recall needs more hashes")
    return best


def gram_set(own: np.ndarray, n: int) -> np.ndarray:
    """The distinct n-gram hashes of one text's word hashes, in order."""
    if not len(own):
        return own
    return np.unique(gram_hashes(own, min(n, len(own))))


def _multipliers(count: int) -> np.ndarray:
    draw = np.random.default_rng(20_240_229).integers(0, 2**31, count, dtype=np.uint32)
    return draw * np.uint32(2) + np.uint32(1)


def _set_key(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def signatures(docs: DataFrame, n: int, rows: int, bands: int) -> DataFrame:
    """doc_id, row_key, node, n_grams, bands; texts without words have no node."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, bounds = words_of(raw_texts(batch))
        h, times = word_hashes(flat), _multipliers(rows * bands)
        nodes, sizes, hashes = [], [], []
        for i in range(batch.num_rows):
            grams = gram_set(h[bounds[i] : bounds[i + 1]], n)
            sizes.append(len(grams))
            if not len(grams):
                nodes.append(None)
                hashes.append([])
                continue
            nodes.append(_set_key(grams))
            short = (grams >> np.uint64(32)).astype(np.uint32)
            least = np.full(rows * bands, np.uint32(0xFFFFFFFF))
            for a in range(0, len(short), 2048):
                np.minimum(least, (short[a : a + 2048, None] * times).min(0), out=least)
            hashes.append([xxhash.xxh3_64_intdigest(b.tobytes()) - 2**63 for b in least.reshape(bands, rows)])
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("row_key"),
                pa.array(nodes, pa.binary()),
                pa.array(sizes, pa.int64()),
                pa.array(hashes, pa.list_(pa.int64())),
            ],
            ["doc_id", "row_key", "node", "n_grams", "bands"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, row_key long, node binary, n_grams long, bands array<bigint>"
    return map_steps(docs, step, schema)


def gram_sets(docs: DataFrame, n: int) -> DataFrame:
    """node, component, copies, blocks, grams: the full sets of chosen rows."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, bounds = words_of(raw_texts(batch))
        h = word_hashes(flat)
        sets = [gram_set(h[bounds[i] : bounds[i + 1]], n) for i in range(batch.num_rows)]
        offsets = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32)
        values = long_column(np.concatenate(sets)) if sets else pa.array([], pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("node", "component", "copies", "blocks")),
                pa.ListArray.from_arrays(pa.array(offsets), values),
            ],
            ["node", "component", "copies", "blocks", "grams"],
        )

    schema = "node binary, component binary, copies long, blocks long, grams array<bigint>"
    return map_steps(docs, step, schema)


def linked(
    sets: list[np.ndarray], side: np.ndarray, threshold: tuple[int, int], across: bool
) -> np.ndarray:
    """Which sets are similar: a square matrix, of pairs across sides only if asked for."""
    m, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    grams, owner = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    column = np.cumsum(np.r_[0, (grams[1:] != grams[:-1]).astype(np.int64)])
    often = np.bincount(column) > 1  # other n-grams are in one set only
    number = np.cumsum(often) - 1
    use = often[column]
    column, owner = number[column[use]], owner[use]
    common, width = np.zeros((m, m)), 4096
    cuts = np.searchsorted(column, np.arange(0, int(often.sum()) + width, width))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        x = np.zeros((m, width), np.float32)
        x[owner[a:b], column[a:b] - k * width] = 1
        common += x @ x.T
    num, den = threshold
    same = common * (num + den) >= num * (sizes[:, None] + sizes[None, :])
    np.fill_diagonal(same, False)
    if across:
        same &= side[:, None] != side[None, :]
    return same


def verify(candidates: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """node, links, peer: how many rows a node is linked to in a group, and a tree's link."""
    own = F.expr("CAST(pmod(xxhash64(node), blocks) AS INT)")
    other = F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("other")
    dealt = candidates.withColumn("own", own).select("*", other).select(
        "node",
        "component",
        "copies",
        "grams",
        "own",
        F.least("own", "other").alias("left"),
        F.greatest("own", "other").alias("right"),
    )

    def compare(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_pylist()
        _, first = np.unique(np.array(nodes, dtype=object).astype("S16"), return_index=True)
        if len(first) != len(nodes):  # rows that repeat id and text
            group = group.take(pa.array(np.sort(first)))
            nodes = group.column("node").to_pylist()
        flat = group.column("grams").combine_chunks()
        values, offsets = flat.values.to_numpy(), flat.offsets.to_numpy()
        sets = [values[a:b] for a, b in zip(offsets, offsets[1:])]
        # One side may be empty; pairs inside the other are counted in its own group.
        across = group.column("left")[0].as_py() != group.column("right")[0].as_py()
        same = linked(sets, group.column("own").to_numpy(), threshold, across)
        copies = group.column("copies").to_numpy()
        links = (same @ copies.astype(np.float64)).astype(np.int64)
        label = np.arange(len(nodes))
        while True:  # the least linked place, as far as links go
            near = np.where(same, label[None, :], len(nodes)).min(1)
            new = np.minimum(label, near)
            new = new[new]
            if (new == label).all():
                break
            label = new
        hit = np.flatnonzero(links)
        return pa.table(
            {
                "node": pa.array([nodes[i] for i in hit], pa.binary()),
                "links": pa.array(links[hit], pa.int64()),
                "peer": pa.array([nodes[label[i]] for i in hit], pa.binary()),
            }
        )

    groups = dealt.groupBy("component", "left", "right")
    return groups.applyInArrow(compare, "node binary, links long, peer binary")


def near_copies(
    docs: DataFrame,
    n: int = N_GRAM,
    threshold: tuple[int, int] = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """doc_id, row_key, class_id, copy_of, n_links, n_grams for each row.

    ``class_id`` is the least id that a row is linked to, directly or over others;
    ``copy_of`` the least id with the same n-gram set; ``n_links`` the number of
    other rows that are similar, copies included. ``row_key`` is a hash of the text.
    """
    rows, bands = band_plan(threshold[0] / threshold[1], recall)
    texts = in_order(docs, "doc_id", "text").withColumn("row_key", F.xxhash64("text"))
    signed = written(signatures(texts, n, rows, bands), "signatures")
    known = signed.where("node IS NOT NULL AND doc_id IS NOT NULL")
    nodes = known.groupBy("node").agg(
        F.count("*").alias("copies"),
        F.min(F.struct("doc_id", "row_key")).alias("row"),
        F.first("n_grams").alias("n_grams"),
        F.first("bands").alias("bands"),
    )
    nodes = written(nodes, "nodes")

    buckets = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    leaders = buckets.groupBy("band", "bucket").agg(
        F.min("node").alias("leader"), F.max("node").alias("last")
    )
    leaders = leaders.where("leader < last").drop("last")
    stars = buckets.join(leaders, ["band", "bucket"]).where("node <> leader")
    groups = star_components(stars.select("node", "leader"))

    members = nodes.drop("bands").join(groups.withColumnRenamed("root", "component"), "node")
    sizes = members.groupBy("component").agg(
        F.ceil(F.sum("n_grams") / BLOCK_GRAMS).cast("long").alias("blocks")
    )
    chosen = members.join(sizes, "component").select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.row_key").alias("row_key"),
        "node", "component", "copies", "blocks",
    )
    sets = gram_sets(texts.join(chosen, ["doc_id", "row_key"]), n)
    found = written(verify(sets, threshold), "links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    trees = star_components(found.where("node <> peer").selectExpr("node", "peer AS leader"))
    classes = nodes.select("node", "copies", F.col("row.doc_id").alias("copy_of"))
    classes = classes.join(links, "node", "left").join(trees, "node", "left")
    classes = classes.withColumn("root", F.coalesce("root", "node"))
    firsts = classes.groupBy("root").agg(F.min("copy_of").alias("class_id"))
    classes = classes.join(firsts, "root").select(
        "node",
        "copy_of",
        "class_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    # A row without a node, or without an id, is alone.
    return signed.drop("bands").join(classes, "node", "left").select(
        "doc_id",
        "row_key",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("copy_of", "doc_id")).alias("copy_of"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0)))
        .otherwise(F.lit(0))
        .cast("long")
        .alias("n_links"),
        "n_grams",
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without near copies: the least id of each class stays.

    Of rows that repeat an id and a text one stays; rows with a null id stay.
    """
    columns = docs.columns
    ours = "row_key" if "row_key" not in columns else "row_key_" + "_".join(columns)
    found = written(near_copies(docs, **options), "near-copies").where("doc_id IS NOT NULL")
    first = found.groupBy("class_id").agg(F.min(F.struct("doc_id", "row_key")).alias("first"))
    rows = found.groupBy("class_id", "doc_id", "row_key").agg(F.count("*").alias("times"))
    judged = rows.join(first, "class_id").select(
        F.col("doc_id").alias("judged_id"),
        F.col("row_key").alias("judged_key"),
        (F.col("first") == F.struct("doc_id", "row_key")).alias("stays"),
        "times",
    )
    # Most rows stay and most that stay are single; only the others are looked up.
    special = judged.where("NOT stays OR times > 1")
    keyed = docs.withColumn(ours, F.xxhash64(F.col("text")))
    match = (keyed["doc_id"] == special["judged_id"]) & (keyed[ours] == special["judged_key"])
    marked = keyed.join(special, match, "left")
    single = marked.where("stays IS NULL").select(*columns)
    repeated = marked.where("stays").dropDuplicates(["judged_id", "judged_key"]).select(*columns)
    return single.unionByName(repeated)


def op8_links(documents: DataFrame) -> DataFrame:
    return near_copies(documents).select("doc_id", "class_id", "copy_of", "n_links", "n_grams")
