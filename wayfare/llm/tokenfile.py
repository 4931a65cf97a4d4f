"""Operator 3: token ids in files of frequency-ranked, byte-aligned variable-length codes.

An id's code is its frequency rank over the whole corpus, so the commonest 256 ids take
one byte. A block holds whole consecutive documents and keeps control and data bytes
apart: a control byte has four 2-bit lengths (1 to 4 bytes, lowest bits first), the data
bytes are the little-endian ranks without their leading zero bytes. Decoding looks the
control bytes up in a 256-row table of lengths; numpy does a block at once.

The files lie below one folder: ``ranks`` has (rank, id), ``blocks`` has one Parquet row
for each block: its place in the order (part, block), the number of ids before it, its
documents and their lengths, control bytes, data bytes and a CRC-32 of both. Parts follow
each other in ascending doc_id order, and so do blocks in a part.

Defined results: a null or empty text is just the end id; null doc_ids come first; rows
that repeat a doc_id follow each other, by the hash of their texts. An empty table gives files without blocks. A very
long text is a long block of its own.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wayfare.llm.shared import SLICE_ROWS, Scratch, no_collection
from wayfare.llm.tokens import MORE_PIECES, ids_crc32, read_tokenizer, text_encoder

END_ID = 2
BLOCK_IDS = 1 << 16
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1

# Staged blocks hold ids, in 16 bits where the vocabulary fits; the row COUNTS of each part
# holds (as 64-bit pairs) the ids of that part with their counts.
STAGED = "part int, block int, part_start long, doc_ids array<long>, lengths array<long>, ids binary"
COUNTS = -1
BLOCKS = ("part int, block int, start long, doc_ids array<long>, lengths array<long>, "
          "control binary, data binary, crc32 long")


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit ranks."""
    ranks = ranks.astype("<u4")
    extra = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    top = int(ranks.max(initial=0))
    for bound in (0xFF, 0xFFFF, 0xFFFFFF):
        if top > bound:
            extra[:len(ranks)] += ranks > bound
    control = extra[0::4] | extra[1::4] << 2 | extra[2::4] << 4 | extra[3::4] << 6
    width = int(extra.max(initial=0)) + 1
    used = np.empty((len(ranks), width), dtype=bool)
    for k in range(width):
        used[:, k] = extra[:len(ranks)] >= k
    data = ranks.astype("<u2").view(np.uint8) if width == 2 else ranks.view(np.uint8).reshape(-1, 4)[:, :width].ravel()
    return control.tobytes(), np.compress(used.ravel(), data).tobytes()


def decode_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    sizes = LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()[:count]
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    raw = np.frombuffer(data, dtype=np.uint8)
    out = raw[starts].astype(np.uint32)
    for k in range(1, int(sizes.max(initial=1))):
        more = np.flatnonzero(sizes > k)
        out[more] |= raw[starts[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _id_type(model: str, end_id: int) -> np.dtype:
    size = max(Tokenizer.from_str(model).get_vocab_size(), end_id + 1)
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def _stage_ids(docs: DataFrame, model: str, end_id: int, parts: int) -> DataFrame:
    """Blocks of ids in ascending doc_id order, numbered inside each range partition, and
    the counts of the ids in each partition.

    Rows of one doc_id go by their text's hash; that and the row's number spread them over
    ranges, so no doc_id's rows are one task's."""
    id_type = _id_type(model, end_id)

    def run(batches):
        from pyspark import TaskContext
        encoder, part = text_encoder(model, end_id, MORE_PIECES), TaskContext.get().partitionId()
        held, held_ids, count, block, start = [], [], 0, 0, 0
        total = np.zeros(0, dtype=np.int64)

        def row(*values):
            types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(values, types)],
                                              names=["part", "block", "part_start", "doc_ids", "lengths", "ids"])

        def flush():
            nonlocal total
            ids = np.concatenate(held_ids)
            got = np.bincount(ids, minlength=len(total))
            got[:len(total)] += total
            total = got
            return row(part, block, start, held, [len(x) for x in held_ids], ids.astype(id_type).tobytes())
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                with no_collection():
                    rows = batch.slice(at, SLICE_ROWS).to_pydict()
                    found = encoder.encode(rows["text"])
                for doc_id, ids in zip(rows["doc_id"], found):
                    held.append(doc_id), held_ids.append(ids)
                    count += len(ids)
                    if count >= BLOCK_IDS:
                        yield flush()
                        held, held_ids, block, start, count = [], [], block + 1, start + count, 0
        if held:
            yield flush()
        found = np.flatnonzero(total)
        if len(found):
            yield row(part, COUNTS, 0, [], [], np.stack([found, total[found]], axis=1).astype("<i8").tobytes())

    first = F.col("doc_id").asc_nulls_first()
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_hash"),
                           F.monotonically_increasing_id().alias("_row"))
               .repartitionByRange(parts, first, "_hash", "_row")
               .sortWithinPartitions(first, "_hash", "text").select("doc_id", "text"))
    return ordered.mapInArrow(run, STAGED)


def _frequencies(staged: DataFrame, parts: int) -> DataFrame:
    """(id, n): the parts' counts are summed as arrays, many parts to a task, before rows of
    one id each are made."""
    def run(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for counts in batch.column(0):
                pairs = np.frombuffer(counts.as_buffer(), dtype="<i8").reshape(-1, 2)
                if len(pairs) and pairs[-1, 0] >= len(total):
                    total = np.concatenate([total, np.zeros(int(pairs[-1, 0]) + 1 - len(total), np.int64)])
                total[pairs[:, 0]] += pairs[:, 1]
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["id", "n"])
    counts = staged.filter("counts").select("ids").coalesce(max(4, parts // 64))
    return counts.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text) and write the files below ``folder``.

    The driver holds one count for each vocabulary id and one for each part."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scratch = Scratch(spark, "tokens")
    model = read_tokenizer(tokenizer_path)
    id_type = _id_type(model, end_id)
    # Counts lie in a folder of their own: reading them touches no ids.
    path = f"{scratch.root}/ids"
    (_stage_ids(docs, model, end_id, parts).withColumn("counts", F.col("block") == COUNTS)
     .write.partitionBy("counts").parquet(path))
    staged = spark.read.schema(f"{STAGED}, counts boolean").parquet(path)
    staged.scratch_path = path
    blocks = staged.filter("NOT counts").drop("counts")
    ranked = sorted(((r["n"], r["id"]) for r in _frequencies(staged, parts).collect()), key=lambda x: (-x[0], x[1]))
    ids = [i for _, i in ranked]
    spark.createDataFrame(list(enumerate(ids)), "rank int, id int").coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(max(ids, default=0) + 1, dtype=np.uint32)
    rank_of[ids] = np.arange(len(ids))
    totals = blocks.groupBy("part").agg(F.max(F.col("part_start") + F.expr(
        "aggregate(lengths, 0L, (a, x) -> a + x)")).alias("n")).orderBy("part").collect()
    first, at = {}, 0
    for r in totals:
        first[r["part"]], at = at, at + r["n"]

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                part = row.column(0)[0].as_py()
                control, data = encode_ranks(rank_of[np.frombuffer(row.column(5)[0].as_buffer(), dtype=id_type)])
                yield pa.RecordBatch.from_arrays(
                    [row.column(0), row.column(1), pa.array([first[part] + row.column(2)[0].as_py()], pa.int64()),
                     row.column(3), row.column(4), pa.array([control], pa.binary()), pa.array([data], pa.binary()),
                     pa.array([zlib.crc32(data, zlib.crc32(control))], pa.int64())],
                    names=["part", "block", "start", "doc_ids", "lengths", "control", "data", "crc32"])
    blocks.mapInArrow(run, BLOCKS).write.partitionBy("part").parquet(f"{folder}/blocks")
    scratch.drop(staged)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the files."""
    ranks = spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()
    id_of = np.array([r["id"] for r in ranks], dtype=np.uint32)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(i)[k].as_py() for i, n in enumerate(batch.schema.names)}
                if zlib.crc32(row["data"], zlib.crc32(row["control"])) != row["crc32"]:
                    raise ValueError("a block of token ids is damaged")
                lengths = np.array(row["lengths"], dtype=np.int64)
                ends = np.cumsum(lengths)
                ids = id_of[decode_ranks(row["control"], row["data"], int(ends[-1]))]
                own = [ids[e - n:e] for n, e in zip(lengths, ends)]
                out = [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - lengths),
                       pa.array(lengths), pa.array([ids_crc32(x) for x in own], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    out, names = out + [pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32()))], names + ["ids"]
                yield pa.RecordBatch.from_arrays(out, names=names)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    return blocks.select("start", "doc_ids", "lengths", "control", "data", "crc32").mapInArrow(run, schema)


def token_file_query(documents: DataFrame) -> DataFrame:
    """Query ``op3_token_ids``: write the files, then read every document back."""
    import public_tokenizers

    spark = documents.sparkSession
    folder = Scratch(spark, "tokenfile").root
    write_token_files(documents, public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_token_files(spark, folder)
