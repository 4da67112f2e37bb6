"""Operator 12: Merkle manifest of a dataset, with an inclusion proof for every row.

Each row is a leaf; per source the leaves ascend by ``doc_id`` and every
:data:`ARITY` consecutive nodes become their hash, level by level, until one node
(the subroot) remains; the subroots, by source, give the root in the same way.

Proofs come from an aligned append (:class:`Append`): leaves are appended in order,
a node joins the open run of its level, and a run that fills (or ends) becomes a
node of the next level.  Every leaf below a run's nodes carries a partial witness,
which the completion of the run extends by the node's siblings.  A task appends
one aligned block of :data:`BLOCK` leaves; the roots of the blocks are appended in
turn, by blocks again (:func:`append_rounds`), and what their completion adds is
put after the witnesses of the leaves below.

Defined cases: null fields are ``-`` in the leaf, so null and empty differ; rows of
one ``doc_id`` are leaves each, ordered by their hash (equal rows are equal leaves,
and which of their places each takes makes no difference but to its proof); a null
``doc_id`` comes first and is never tampered with; a null source is a source of its
own, the first; an empty table gives no rows; other columns aren't read.

Scale: only hashes move, never texts.  A leaf's place comes from a range partition
over (source, doc_id, hash) and one offset per partition and source, so a source
with a third of all rows is spread over many tasks.  A block has at most
:data:`BLOCK` nodes, so a task holds a few hundred rows and a witness grows by two
hashes a level; rounds are logarithmic to the base of the block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sameitem.llm.common import prepared, runs, stage, table
from sameitem.operators.groups import consecutive_ids

ARITY = 3
#: Levels and leaves of a block.
DEPTH = 6
BLOCK = ARITY ** DEPTH
DIGEST = 32


def sha256_hex(parts: list[bytes]) -> bytes:
    """Raw digest of the concatenated parts, digests as hex text."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


class Append:
    """Aligned append of up to :data:`BLOCK` nodes; ``witness[i]`` is what node ``i`` has so far.

    A witness is a list of steps, each ``slot, run size`` (a byte each) and the
    run's other nodes from left to right.
    """

    def __init__(self) -> None:
        self.open: list[list[tuple[bytes, int, int]]] = [[]]  # by level: digest, first and last leaf below
        self.witness: list[bytearray] = []

    def add(self, digest: bytes) -> None:
        at = len(self.witness)
        self.witness.append(bytearray())
        self._put(0, (digest, at, at + 1))

    def _put(self, level: int, node: tuple[bytes, int, int]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == ARITY:
            self.complete(level)

    def complete(self, level: int) -> None:
        """Close the run of a level: extend the witnesses below it and append its hash above."""
        run, self.open[level] = self.open[level], []
        for slot, (_, lo, hi) in enumerate(run):
            step = bytes((slot, len(run))) + b"".join(d for i, (d, _, _) in enumerate(run) if i != slot)
            for leaf in range(lo, hi):
                self.witness[leaf] += step
        self._put(level + 1, (sha256_hex([d for d, _, _ in run]), run[0][1], run[-1][2]))

    def finish(self, levels: int | None = None) -> bytes:
        """The root: of a block of ``levels`` levels, or (None) as soon as one node remains."""
        level = 0
        while True:
            run = self.open[level]
            above = any(self.open[level + 1:])
            if level == levels or (levels is None and not above and len(run) == 1):
                return run[0][0]
            if run:
                self.complete(level)
            level += 1


def steps(witness: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """``(slot, siblings)`` of each step."""
    at = 0
    while at < len(witness):
        slot, size = witness[at], witness[at + 1]
        at += 2
        yield slot, [witness[at + DIGEST * i:at + DIGEST * (i + 1)] for i in range(size - 1)]
        at += DIGEST * (size - 1)


def fold(digest: bytes, witness: bytes) -> bytes:
    """The root that a leaf's digest and its witness give."""
    for slot, others in steps(witness):
        digest = sha256_hex([*others[:slot], digest, *others[slot:]])
    return digest


def proof(witness: bytes) -> bytes:
    """Hash of all siblings, from the leaf's level up, left to right."""
    return sha256_hex([d for _, others in steps(witness) for d in others])


# -- leaves and their places ---------------------------------------------------------

def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(text: Column) -> Column:
    """Raw digest of a row whose text is ``text``."""
    return F.unhex(F.sha2(F.encode(F.concat(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text)), "UTF-8"), 256))


def leaves(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, source, digest, tampered``: the tampered digest is that of the row without line feeds in its text."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                      F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"),
                      F.col("text").cast("string").alias("text"))
    touched = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0, F.lit(False))
    changed = touched & F.coalesce(F.col("text").contains("\n"), F.lit(False))
    return stage(spark, own.select("doc_id", "source", leaf_hash(F.col("text")).alias("digest"),
                                   F.when(changed, leaf_hash(F.translate("text", "\n", ""))).alias("tampered")), "merkle-leaves")


def placed(spark: SparkSession, own: DataFrame) -> DataFrame:
    """Add ``tree`` (number of the source, null first), ``n`` (its leaves) and ``pos`` (place among them, from 0)."""
    order = ["source", "doc_id", "digest"]
    parts = stage(spark, own.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
                  .withColumn("part", F.spark_partition_id()), "merkle-order")
    counts = stage(spark, parts.groupBy("part", "source").agg(F.count(F.lit(1)).alias("here")), "merkle-counts")
    sources = counts.groupBy("source").agg(F.sum("here").alias("n"))
    sources = consecutive_ids(sources, "source", "tree").select(F.col("source").alias("_s"), "n", (F.col("tree") - 1).alias("tree"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("here").over(before), F.lit(0)))
    offsets = offsets.join(sources, F.col("source").eqNullSafe(F.col("_s"))).select(
        F.col("part").alias("_p"), "_s", "n", "tree", "before")
    # A source's share of one partition is what a window sees.
    within = Window.partitionBy("part", "source").orderBy(F.col("doc_id").asc_nulls_first(), "digest")
    found = parts.withColumn("_in", F.row_number().over(within)).join(
        offsets, (F.col("part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s")))
    return stage(spark, found.select("doc_id", "digest", "tampered", "tree", "n",
                                     (F.col("before") + F.col("_in") - 1).alias("pos")), "merkle-places")


# -- rounds of appends -----------------------------------------------------------------

def _appended(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for own in runs(records, ["tree", "block"]):
        whole = own["n"][0].as_py() <= BLOCK
        append = Append()
        for digest in own["digest"].to_pylist():
            append.add(digest)
        root = append.finish(None if whole else DEPTH)
        own = own.append_column("witness", pa.array([bytes(w) for w in append.witness], pa.binary()))
        own = own.append_column("root", pa.array([root] * own.num_rows, pa.binary()))
        yield from own.combine_chunks().to_batches()


def append_rounds(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """Add ``witness`` and ``root`` (of the tree) to nodes with ``tree, n, pos, digest``.

    ``n`` is the number of the tree's nodes.  A round appends each aligned block by
    itself; where a tree has more than one, the block roots are the nodes of the
    next round, whose witnesses go on after those of the nodes below.
    """
    prepared(spark)
    own = nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema.fields) + ", witness binary, root binary"
    own = stage(spark, own.repartition("tree", "block").sortWithinPartitions("tree", "pos").mapInArrow(_appended, schema), "merkle-round")
    more = own.where(F.col("n") > BLOCK)
    if more.isEmpty():
        return own.drop("block")
    roots = more.groupBy("tree", "block").agg(F.first("root").alias("digest"), F.first("n").alias("n"))
    above = append_rounds(spark, roots.select("tree", F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("block").alias("pos"), "digest"))
    above = above.select(F.col("tree").alias("_t"), F.col("pos").alias("_b"), F.col("witness").alias("_w"), F.col("root").alias("_r"))
    met = own.join(above, (F.col("tree") == F.col("_t")) & (F.col("block") == F.col("_b")), "left")
    return met.select(*nodes.columns, F.concat("witness", F.coalesce("_w", F.lit(b""))).alias("witness"),
                      F.coalesce("_r", "root").alias("root"))


def _checked(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in records:
        column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
        leaf, root = column["digest"].to_pylist(), column["root"].to_pylist()
        witness = [a + b for a, b in zip(column["witness"].to_pylist(), column["upper"].to_pylist())]
        shown = [t or d for t, d in zip(column["tampered"].to_pylist(), leaf)]
        folded = [fold(d, w) for d, w in zip(shown, witness)]
        text = lambda values: pa.array([v.hex() for v in values], pa.string())
        yield pa.RecordBatch.from_arrays(
            [column["doc_id"], text(leaf), text(column["subroot"].to_pylist()), text(root), text([proof(w) for w in witness]),
             text(folded), pa.array(np.array([a == b for a, b in zip(folded, root)], dtype=bool))],
            ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


CHECKED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def witnesses(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, digest, tampered, subroot, witness, upper, root`` of every row.

    ``witness`` leads to the source's subroot and ``upper`` from there to the root.
    """
    own = append_rounds(spark, placed(spark, leaves(spark, docs)))
    subroots = own.groupBy("tree").agg(F.first("root").alias("digest")).withColumn("pos", F.col("tree"))
    total = subroots.count()
    tops = append_rounds(spark, subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(total).cast("long").alias("n"), "pos", "digest"))
    tops = tops.select(F.col("pos").alias("_t"), F.col("witness").alias("upper"), F.col("root").alias("_root"))
    return own.withColumnRenamed("root", "subroot").join(tops, F.col("tree") == F.col("_t")).select(
        "doc_id", "digest", "tampered", "subroot", "witness", "upper", F.col("_root").alias("root"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return witnesses(spark, table(spark, sf_dir, "documents")).mapInArrow(_checked, CHECKED)


def oracle() -> str:
    """DuckDB SQL of :func:`op12_merkle`: levels by recursion, no blocks and no witnesses."""
    enc = lambda c: f"case when {c} is null then '-' else strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR end"
    leaf = lambda t: "sha256(" + " || ".join(enc(c) for c in ("doc_id", "source", "lang", "n_chars", t)) + ")"
    levels = lambda name, src: (
        f"{name} as (select * from {src} union all select tree, lvl + 1, pos // {ARITY}, (any_value(n) + {ARITY - 1}) // {ARITY}, "
        f"sha256(string_agg(digest, '' order by pos)) from {name} where n > 1 group by tree, lvl, pos // {ARITY})")
    around = lambda name, src: (
        f"{name} as (select a.tree, a.lvl, a.pos, coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos < a.pos), '') as lft, "
        f"coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos > a.pos), '') as rgt from {src} a join {src} b "
        f"on a.tree = b.tree and a.lvl = b.lvl and a.pos // {ARITY} = b.pos // {ARITY} where a.n > 1 group by a.tree, a.lvl, a.pos)")
    # crc32 by table: eight shifts of each byte, then one step a digit.
    table_ = ("B as (select i, 0 as k, i::BIGINT as c from range(256) t(i) union all select i, k + 1, "
              "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from B where k < 8),\n"
              "TB as (select list(c order by i) as tb from B where k = 8)")
    crc = ("xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), "
           "lambda c, b: xor(c >> 8, tb[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)")
    return f"""
with recursive {table_},
D as (select row_number() over () as rid, doc_id, source, lang, n_chars, text, coalesce(doc_id is not null and {crc} % 2 = 0, false) as touched from documents, TB),
H as (select rid, doc_id, source, {leaf('text')} as leaf, case when touched then {leaf("replace(text, chr(10), '')")} end as bad from D),
SRC as (select source, row_number() over (order by source nulls first) - 1 as tree from (select distinct source from D)),
P as (select H.*, SRC.tree, row_number() over (partition by SRC.tree order by doc_id nulls first, leaf, rid) - 1 as pos,
  count(*) over (partition by SRC.tree) as n from H join SRC on H.source is not distinct from SRC.source),
L0 as (select tree, 0 as lvl, pos, n, leaf as digest from P),
{levels('LV', 'L0')},
SUB as (select tree, digest as subroot from LV where n = 1),
U0 as (select 0::BIGINT as tree, 0 as lvl, tree as pos, count(*) over () as n, subroot as digest from SUB),
{levels('UP', 'U0')},
RT as (select digest as root from UP where n = 1),
{around('SB', 'LV')},
{around('SU', 'UP')},
W1 as (select rid, string_agg(lft || rgt, '' order by lvl) as w from P join SB on SB.tree = P.tree and SB.pos = P.pos // ({ARITY} ** SB.lvl)::BIGINT group by rid),
W2 as (select S.tree, string_agg(lft || rgt, '' order by lvl) as w from SUB S join SU on SU.pos = S.tree // ({ARITY} ** SU.lvl)::BIGINT group by S.tree),
F1 as (select rid, tree, pos, 0 as lvl, coalesce(bad, leaf) as cur from P union all
  select F1.rid, F1.tree, F1.pos // {ARITY}, F1.lvl + 1, sha256(lft || cur || rgt) from F1 join SB on SB.tree = F1.tree and SB.lvl = F1.lvl and SB.pos = F1.pos),
E1 as (select rid, tree, arg_max(cur, lvl) as cur from F1 group by rid, tree),
F2 as (select rid, tree as pos, 0 as lvl, cur from E1 union all
  select F2.rid, F2.pos // {ARITY}, F2.lvl + 1, sha256(lft || cur || rgt) from F2 join SU on SU.lvl = F2.lvl and SU.pos = F2.pos),
E2 as (select rid, arg_max(cur, lvl) as cur from F2 group by rid)
select P.doc_id, P.leaf, SUB.subroot, RT.root, sha256(coalesce(W1.w, '') || coalesce(W2.w, '')) as proof_sha256,
  E2.cur as folded_root, E2.cur = RT.root as verified
from P join SUB using (tree) join E2 using (rid) cross join RT left join W1 using (rid) left join W2 on W2.tree = P.tree"""
