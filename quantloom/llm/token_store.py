"""Token ids in binary shards with a minimal perfect hash index.

A store is a Parquet table of shards in ascending order of keys. A shard holds up to about a million ids of whole
documents: ``payload`` the raw ids end to end, ``keys`` the documents' keys, ``ends`` where each document ends in the
payload, and an index of its own: ``levels`` the bitmaps of a minimal perfect hash function over the distinct keys, and
for each of its slots ``prints`` a fingerprint of the key, ``record`` the first document of that key and ``copies`` how
many follow with the same key. A key is found in constant time: hash, slot, fingerprint, place. All bytes go through
Spark's writer, so the store can lie wherever Spark can write, and a lost task is simply run again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantloom.llm.bpe import encoder
from quantloom.llm.common import whole

SHARD_IDS = 1 << 20
GAMMA = 2  # slots for each key at a level of the hash function
STORE = (
    "part int, shard int, ahead long, first_key string, last_key string, n_docs int, n_ids long, width int, "
    "keys binary, ends binary, levels binary, prints binary, record binary, copies binary, payload binary"
)
NULL_KEY = b"\x00null"


def _mix(h: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = h + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def hash_keys(keys: list[str | None]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(NULL_KEY if k is None else k.encode()) for k in keys], dtype=np.uint64)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit hashes: at each level keys alone in their slot stay, others go on."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.bases = np.cumsum([0, *(int(x.sum()) for x in levels)])
        self.ranks = [np.cumsum(x) - x for x in levels]

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        levels = []
        while len(hashes):
            slots = (_mix(hashes, len(levels)) % np.uint64(max(2, GAMMA * len(hashes)))).astype(np.int64)
            count = np.bincount(slots, minlength=max(2, GAMMA * len(hashes)))
            levels.append((count == 1).astype(np.int64))
            hashes = hashes[count[slots] > 1]
        return cls(levels)

    def slot(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash; -1 where no level holds it. A strange hash may get any slot: compare fingerprints."""
        out, open_ = np.full(len(hashes), -1, np.int64), np.arange(len(hashes))
        for i, bits in enumerate(self.levels):
            at = (_mix(hashes[open_], i) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at] == 1
            out[open_[hit]] = self.bases[i] + self.ranks[i][at[hit]]
            open_ = open_[~hit]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *(len(x) for x in self.levels)], dtype="<u4").tobytes()
        return sizes + b"".join(np.packbits(x.astype(np.uint8)).tobytes() for x in self.levels)

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        count = int(np.frombuffer(data, "<u4", 1)[0])
        sizes, at, levels = np.frombuffer(data, "<u4", count, 4).tolist(), 4 + 4 * count, []
        for n in sizes:
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8), at), count=n).astype(np.int64))
            at += -(-n // 8)
        return cls(levels)


def _pack_keys(keys: list[str | None]) -> bytes:
    raw = [b"" if k is None else k.encode() for k in keys]
    sizes = np.array([-1 if k is None else len(r) for k, r in zip(keys, raw, strict=True)], dtype="<i4")
    return sizes.tobytes() + b"".join(raw)


def _unpack_keys(data: bytes, n: int) -> list[str | None]:
    sizes, at, out = np.frombuffer(data, "<i4", n).tolist(), 4 * n, []
    for size in sizes:
        out.append(None if size < 0 else data[at : at + size].decode())
        at += max(size, 0)
    return out


def _shard(part: int, number: int, ahead: int, width: int, keys: list[str | None], ids: list[bytes]) -> tuple:
    ends = np.cumsum([len(x) // width for x in ids])
    hashes = hash_keys(keys)
    distinct, record, copies = np.unique(hashes, return_index=True, return_counts=True)
    ph = PerfectHash.build(distinct)
    slot = ph.slot(distinct)
    cells = np.zeros((3, len(distinct)), dtype=np.int64)
    cells[:, slot] = (distinct >> np.uint64(32)).astype(np.int64), record, copies
    return (
        part, number, ahead, keys[0], keys[-1], len(keys), int(ends[-1]), width, _pack_keys(keys), ends.astype("<i8").tobytes(),
        ph.dump(), cells[0].astype("<u4").tobytes(), cells[1].astype("<u4").tobytes(), cells[2].astype("<u4").tobytes(), b"".join(ids),
    )


def write_store(
    docs: DataFrame,
    path: str,
    out: str,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    partitions: int | None = None,
    shard_ids: int = SHARD_IDS,
) -> None:
    """Encode every whole text, add ``end_id`` and write the shards to folder ``out`` in ascending order of ``doc_id``.

    Null text is empty: the end id alone. Null ids come first. Rows that repeat an id are documents of their own next to
    each other, in the order of their texts; if they cross shards, each shard's index knows its own. Other columns are
    ignored; an empty table gives an empty store. A document longer than a shard gets one by itself.
    """
    columns = STORE.split(", ")
    names = [c.split(" ")[0] for c in columns]

    def shards(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code, part_no = encoder(path), TaskContext.get().partitionId()
        end = np.array([end_id], dtype=code.kind).tobytes()
        keys, ids, held, ahead, number = [], [], 0, 0, 0
        for part in parts:
            for key, t in zip(part["key"], part["t"], strict=True):
                row, key = code.encode(t) + end, None if pd.isna(key) else key
                n = len(row) // code.width
                if keys and held + n > shard_ids:
                    yield pd.DataFrame([_shard(part_no, number, ahead, code.width, keys, ids)], columns=names)
                    ahead, number, keys, ids, held = ahead + held, number + 1, [], [], 0
                keys.append(key)
                ids.append(row)
                held += n
        if keys:
            yield pd.DataFrame([_shard(part_no, number, ahead, code.width, keys, ids)], columns=names)

    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("key_order"), whole(text).alias("t"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "key_order").sortWithinPartitions("key_order", "t")
    ordered.select(F.col("key_order").cast("string").alias("key"), "t").mapInPandas(shards, STORE).write.mode("overwrite").parquet(out)


def _starts(store: DataFrame) -> DataFrame:
    """Ids ahead of each partition: (s_part, before), a row for each written partition; handed to every task, so that no payload is shuffled."""
    sums = store.groupBy("part").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(sums.select(F.col("part").alias("s_part"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before")))


class Shard:
    """A shard row, ready for keyed access."""

    def __init__(self, row):
        self.ends = np.frombuffer(row.ends, "<i8")
        self.begins = np.concatenate([[0], self.ends[:-1]])
        self.hash, self.prints = PerfectHash.load(row.levels), np.frombuffer(row.prints, "<u4")
        self.record, self.copies = np.frombuffer(row.record, "<u4"), np.frombuffer(row.copies, "<u4")
        self.ids = np.frombuffer(row.payload, f"<u{row.width}")

    def find(self, keys: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key; none where the fingerprint differs."""
        h = hash_keys(keys)
        slot = self.hash.slot(h)
        safe = np.maximum(slot, 0)
        if not len(self.prints):
            return safe, np.zeros(len(keys), np.int64)
        known = (slot >= 0) & (self.prints[safe] == (h >> np.uint64(32)).astype(np.uint32))
        return self.record[safe].astype(np.int64), np.where(known, self.copies[safe], 0).astype(np.int64)

    def document(self, record: int) -> np.ndarray:
        return self.ids[self.begins[record] : self.ends[record]]


def read_documents(spark: SparkSession, path: str, doc_type: str = "bigint") -> DataFrame:
    """Every document of a store, found by key through the index of its shard and cut from the payload.

    Rows: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers).
    """
    store = spark.read.schema(STORE).parquet(path)
    placed = store.join(_starts(store), F.col("part") == F.col("s_part")).drop("s_part")

    def look_up(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples(index=False):
                shard, keys = Shard(row), _unpack_keys(row.keys, row.n_docs)
                record, copies = shard.find(list(dict.fromkeys(keys)))
                if int(copies.sum()) != row.n_docs:
                    raise ValueError(f"the index of shard {row.part}/{row.shard} does not cover its documents")
                out = []
                for key, r, c in zip(dict.fromkeys(keys), record.tolist(), copies.tolist(), strict=True):
                    for k in range(r, r + c):
                        ids = shard.document(k)
                        out.append((key, row.before + row.ahead + int(shard.begins[k]), len(ids), zlib.crc32(ids.astype("<u4"))))
                yield pd.DataFrame(out, columns=["key", "start", "n_tokens", "ids_crc32"]).astype({"key": object})

    found = placed.mapInPandas(look_up, "key string, start long, n_tokens long, ids_crc32 long")
    return found.select(F.col("key").cast(doc_type).alias("doc_id"), "start", "n_tokens", "ids_crc32")


def look_up(spark: SparkSession, path: str, keys: DataFrame, key: str, doc_type: str = "bigint") -> DataFrame:
    """Keyed access: rows (key, start, ids) of the store's documents for each distinct key; absent and null keys have none.

    A key goes to its written partition by the bounds of the partitions (one row for each that the writer was given), from
    there to its shard by the shards' bounds, and in the shard through the perfect hash and the fingerprint.
    """
    store = spark.read.schema(STORE).parquet(path)
    bounds = store.select("part", "shard", *[F.col(c).cast(doc_type).alias(c) for c in ("first_key", "last_key")])
    parts = bounds.groupBy("part").agg(F.min("first_key").alias("p_first"), F.max("last_key").alias("p_last"))
    wanted = keys.select(F.col(key).cast(doc_type).alias("key")).where("key is not null").distinct()
    routed = wanted.join(F.broadcast(parts), F.col("key").between(F.col("p_first"), F.col("p_last")))
    inside = (F.col("part") == F.col("b_part")) & F.col("key").between(F.col("first_key"), F.col("last_key"))
    routed = routed.join(bounds.withColumnRenamed("part", "b_part"), inside).select("part", "shard", F.col("key").cast("string").alias("key"))
    store = spark.read.schema(STORE).parquet(path)
    held = store.join(routed.select("part", "shard").distinct(), ["part", "shard"], "left_semi")
    held = held.join(_starts(store), F.col("part") == F.col("s_part")).drop("s_part")

    def fetch(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in rows.itertuples(index=False):
            shard, names = Shard(row), asked["key"].tolist()
            for name, r, c in zip(names, *[x.tolist() for x in shard.find(names)], strict=True):
                for k in range(r, r + c):
                    out.append((name, row.before + row.ahead + int(shard.begins[k]), shard.document(k).tolist()))
        return pd.DataFrame(out, columns=["key", "start", "ids"])

    found = routed.groupBy("part", "shard").cogroup(held.groupBy("part", "shard")).applyInPandas(fetch, "key string, start long, ids array<long>")
    return found.select(F.col("key").cast(doc_type).alias(key), "start", "ids")
