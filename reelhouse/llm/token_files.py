"""Token ids in binary shards, with a minimal perfect hash index by document.

A shard file is a header and the raw ids of its documents one after the other, as little-
endian numbers of two bytes, or of four where the vocabulary is larger. Shards follow each
other in ascending order of document ids. An index file holds a part of the documents, by
hash of the key: a minimal perfect hash function that gives every key a slot of its own,
and for each slot a fingerprint of its key, the shard, and the place in it. A lookup
computes the slot, compares the fingerprint and reads the ids, whatever the number of
documents.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import pick, shared_folder, written
from .files import attempt_name, filesystem
from .tokens import WordEncoder

_SHARD = "<8sII"  # magic, bytes of an id, nothing
_SHARD_BYTES = struct.calcsize(_SHARD)
_INDEX = "<8sIII"  # magic, blocks, pilots, keys
_SLOT = np.dtype([("mark", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u8")])
_U64 = np.uint64


@dataclass(frozen=True)
class Layout:
    """``part_keys`` documents on average share an index file, ``block_keys`` a hash function, ``pilot_keys`` a pilot."""

    end_id: int = 1
    part_keys: int = 16_384
    block_keys: int = 1_024
    pilot_keys: int = 4


def key_hash(doc_id, copy: int) -> int:
    """The hash of the ``copy``-th document, from 0, of an id."""
    return xxhash.xxh64_intdigest(f"{copy}:{'' if doc_id is None else doc_id}:{doc_id is None}")


def _mixed(h: np.ndarray) -> np.ndarray:
    """A well-mixed function of 64-bit numbers."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _U64(31))) * _U64(0x9E3779B97F4A7C15)
        return h ^ (h >> _U64(29))


def _slots(hashes: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (_mixed(hashes ^ (pilots.astype(_U64) * _U64(0xD6E8FEB86659FD93))) >> _U64(8)) % _U64(n)


def _blocks_of(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashes >> _U64(32)) % _U64(blocks)).astype(np.int64)


def _pilot_places(hashes: np.ndarray, pilots: int) -> np.ndarray:
    return ((hashes & _U64(0xFFFFFFFF)) % _U64(pilots)).astype(np.int64)


def _perfect(hashes: np.ndarray, pilots: int) -> np.ndarray:
    """For each group of keys a pilot that sends all of them to free slots; large groups choose first."""
    n, out = len(hashes), np.zeros(pilots, "<u4")
    free = np.ones(n, bool)
    group = _pilot_places(hashes, pilots)
    order = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[order], np.arange(pilots + 1))
    for g in np.argsort(-(starts[1:] - starts[:-1]), kind="stable"):
        keys = hashes[order[starts[g] : starts[g + 1]]]
        if not len(keys):
            break
        first, width = 0, 64
        while True:
            tried = np.arange(first, first + width)
            slots = _slots(keys[None, :], tried[:, None], n)
            good = free[slots.astype(np.int64)].all(1)
            if len(keys) > 1:
                ordered = np.sort(slots, axis=1)
                good &= (ordered[:, 1:] != ordered[:, :-1]).all(1)
            hit = np.flatnonzero(good)
            if len(hit):
                out[g] = tried[hit[0]]
                free[slots[hit[0]].astype(np.int64)] = False
                break
            first, width = first + width, min(4 * width, 1 << 14)
            if first >= 1 << 32:
                raise ValueError("two keys of an index have one hash")
    return out


def build_index(hashes: np.ndarray, shard: np.ndarray, offset: np.ndarray, length: np.ndarray, layout: Layout = Layout()) -> bytes:
    """An index file for distinct key hashes and their places."""
    if len(np.unique(hashes)) != len(hashes):
        raise ValueError("two keys of an index have one hash")
    blocks = max(1, -(-len(hashes) // layout.block_keys))
    block = _blocks_of(hashes, blocks)
    order = np.argsort(block, kind="stable")
    starts = np.searchsorted(block[order], np.arange(blocks + 1)).astype("<u4")
    slots, pilots, pilot_starts = np.zeros(len(hashes), _SLOT), [], [0]
    for b in range(blocks):
        own = order[starts[b] : starts[b + 1]]
        groups = max(1, -(-len(own) // layout.pilot_keys))
        found = _perfect(hashes[own], groups)
        pilots.append(found)
        pilot_starts.append(pilot_starts[-1] + groups)
        if len(own):
            at = _slots(hashes[own], found[_pilot_places(hashes[own], groups)], len(own)).astype(np.int64) + int(starts[b])
            slots["mark"][at] = (_mixed(~hashes[own]) >> _U64(32)).astype("<u4")
            slots["shard"][at], slots["offset"][at], slots["length"][at] = shard[own], offset[own], length[own]
    pilots = np.concatenate(pilots).astype("<u4")
    head = struct.pack(_INDEX, b"TOKMPH01", blocks, len(pilots), len(hashes))
    return b"".join([head, starts.tobytes(), np.array(pilot_starts, "<u4").tobytes(), pilots.tobytes(), slots.tobytes()])


class Index:
    """An index file in memory."""

    def __init__(self, data: bytes) -> None:
        magic, blocks, pilots, keys = struct.unpack_from(_INDEX, data)
        if magic != b"TOKMPH01":
            raise ValueError("not an index file")
        at = struct.calcsize(_INDEX)
        self.starts = np.frombuffer(data, "<u4", blocks + 1, at).astype(np.int64)
        at += 4 * (blocks + 1)
        self.pilot_starts = np.frombuffer(data, "<u4", blocks + 1, at).astype(np.int64)
        at += 4 * (blocks + 1)
        self.pilots = np.frombuffer(data, "<u4", pilots, at)
        self.slots = np.frombuffer(data, _SLOT, keys, at + 4 * pilots)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slots of many keys, and which of the keys are there, up to the chance of a fingerprint (2^-32)."""
        block = _blocks_of(hashes, len(self.starts) - 1)
        n = self.starts[block + 1] - self.starts[block]
        groups = self.pilot_starts[block + 1] - self.pilot_starts[block]
        pilot = self.pilots[self.pilot_starts[block] + _pilot_places(hashes, groups.astype(np.uint64))]
        at = _slots(hashes, pilot, np.maximum(n, 1).astype(np.uint64)).astype(np.int64) + self.starts[block]
        known = n > 0
        slots = self.slots[np.where(known, at, 0)] if len(self.slots) else np.zeros(len(hashes), _SLOT)
        known &= slots["mark"] == (_mixed(~hashes) >> _U64(32)).astype("<u4")
        return slots, known


def _hashes(rows: pd.DataFrame) -> np.ndarray:
    ids = [None if pd.isna(i) else i for i in rows["doc_id"].astype(object)]
    return np.array([key_hash(i, c) for i, c in zip(ids, rows["copy"])], np.uint64)


@dataclass(frozen=True)
class TokenFiles:
    """A written set: ``shards`` (shard, file, start, n_ids), ``parts`` (part, file), and how many index parts there are."""

    folder: str
    shards: DataFrame
    parts: DataFrame
    n_parts: int
    id_kind: str


def _with_copy(rows: DataFrame, *order: str) -> DataFrame:
    return rows.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)) - 1)


def _with_part(rows: DataFrame, n_parts: int) -> DataFrame:
    return rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(n_parts)).cast("int"))


def write_token_files(docs: DataFrame, tokenizer: str, layout: Layout = Layout()) -> TokenFiles:
    """Encode every text of ``docs`` and write shards and index to a new folder of the shared storage.

    Documents are in ascending order of id, null ids first, those of one id by the hash of
    their text; each ends with ``end_id``, so a null or empty text has one id. A task
    writes a file of its own per attempt, and the tables name those of finished tasks.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-files")
    end_id = layout.end_id
    kind = docs.schema["doc_id"].dataType.simpleString()

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = WordEncoder.of(tokenizer)
        width, end = encoder.dtype.itemsize, np.array([end_id], encoder.dtype).tobytes()
        shard = TaskContext.get().partitionId()
        store, path = filesystem(folder)
        store.create_dir(path, recursive=True)
        name, at, out = attempt_name("shard", shard, ".ids"), 0, None
        for part in parts:
            if out is None:
                out = store.open_output_stream(f"{path}/{name}")
                out.write(struct.pack(_SHARD, b"TOKIDS01", width, 0))
            lengths = []
            for ids in encoder.encode(part["text"]):
                out.write(ids)
                out.write(end)
                lengths.append(len(ids) // width + 1)
            lengths = np.array(lengths, np.int64)
            offsets = at + np.cumsum(lengths) - lengths
            at += int(lengths.sum())
            yield pd.DataFrame({"doc_id": part["doc_id"], "shard": np.int32(shard), "file": name, "offset": offsets, "length": lengths})
        if out is not None:
            out.close()

    rows = pick(docs, "doc_id", "text").withColumn("hash", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", F.col("text").cast("binary").alias("text"))
    places = written(ranged.mapInPandas(write, f"doc_id {kind}, shard int, file string, offset long, length long"), "places")

    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    shards = places.groupBy("shard", "file").agg(F.sum("length").alias("n_ids"))
    shards = written(shards.withColumn("start", F.coalesce(F.sum("n_ids").over(upto), F.lit(0))), "shards")

    n_parts = max(1, -(-places.count() // layout.part_keys))

    def index(rows: pd.DataFrame) -> pd.DataFrame:
        part = int(rows["part"].iloc[0])
        data = build_index(_hashes(rows), rows["shard"].to_numpy(), rows["offset"].to_numpy(), rows["length"].to_numpy(), layout)
        store, path = filesystem(folder)
        name = attempt_name("index", part, ".mph")
        with store.open_output_stream(f"{path}/{name}") as out:
            out.write(data)
        return pd.DataFrame({"part": [part], "file": [name]})

    keyed = _with_part(_with_copy(places, "shard", "offset"), n_parts)
    parts = written(keyed.groupBy("part").applyInPandas(index, "part int, file string"), "parts")
    return TokenFiles(folder, shards, parts, n_parts, kind)


def lookup(keys: DataFrame, files: TokenFiles) -> DataFrame:
    """``doc_id``, ``copy``, ``shard``, ``offset`` and ``length`` for those rows of ``keys`` (doc_id, copy) that are in the index."""
    folder, kind = files.folder, files.id_kind

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = filesystem(folder)
        name, index = None, None
        for part in parts:
            for own, rows in part.groupby("file", sort=False):
                if own != name:
                    with store.open_input_file(f"{path}/{own}") as file:
                        name, index = own, Index(file.read())
                slots, known = index.find(_hashes(rows))
                yield pd.DataFrame({
                    "doc_id": rows["doc_id"].array[known], "copy": rows["copy"].to_numpy()[known],
                    "shard": slots["shard"][known].astype(np.int32), "offset": slots["offset"][known].astype(np.int64),
                    "length": slots["length"][known].astype(np.int64),
                })

    located = _with_part(keys.select("doc_id", "copy"), files.n_parts).join(files.parts, "part")
    located = located.repartition("part").sortWithinPartitions("part").select("doc_id", "copy", "file")
    return located.mapInPandas(find, f"doc_id {kind}, copy int, shard int, offset long, length long")


def read_ids(places: DataFrame, files: TokenFiles, with_ids: bool = True) -> DataFrame:
    """The ids at ``places`` (doc_id, copy, shard, offset, length), read shard by shard in order.

    Gives ``doc_id``, ``copy``, ``start`` (ids of all documents before it), ``n_tokens``,
    ``ids_crc32`` (of the ids as four-byte numbers) and, if asked for, ``ids`` as such numbers.
    """
    folder, kind = files.folder, files.id_kind

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = filesystem(folder)
        name, file, dtype = None, None, None
        for part in parts:
            out = {"n_tokens": [], "ids_crc32": [], "ids": []}
            for own, offset, length in zip(part["file"], part["offset"], part["length"]):
                if own != name:
                    if file is not None:
                        file.close()
                    name, file = own, store.open_input_file(f"{path}/{own}")
                    magic, width, _ = struct.unpack(_SHARD, file.read(_SHARD_BYTES))
                    if magic != b"TOKIDS01":
                        raise ValueError(f"{own} is not a shard file")
                    dtype = np.dtype(f"<u{width}")
                file.seek(_SHARD_BYTES + int(offset) * dtype.itemsize)
                ids = np.frombuffer(file.read(int(length) * dtype.itemsize), dtype).astype("<u4").tobytes()
                out["n_tokens"].append(len(ids) // 4)
                out["ids_crc32"].append(zlib.crc32(ids))
                if with_ids:
                    out["ids"].append(ids)
            if not with_ids:
                out.pop("ids")
            yield pd.DataFrame({"doc_id": part["doc_id"].array, "copy": part["copy"].array, "start": (part["start"] + part["offset"]).array, **out})
        if file is not None:
            file.close()

    ready = places.join(files.shards.select("shard", "file", "start"), "shard")
    ready = ready.repartition("shard").sortWithinPartitions("shard", "offset")
    schema = f"doc_id {kind}, copy int, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return ready.select("doc_id", "copy", "file", "offset", "length", "start").mapInPandas(read, schema)


def round_trip(docs: DataFrame, tokenizer: str, layout: Layout = Layout()) -> DataFrame:
    """Write the token files of ``docs``, then look every document up by its key and read its ids back."""
    files = write_token_files(docs, tokenizer, layout)
    keys = _with_copy(pick(docs, "doc_id"), "doc_id").select("doc_id", "copy")
    return read_ids(lookup(keys, files), files, with_ids=False).drop("copy")


class TokenReader:
    """Keyed access from one process: two small reads for each document, however many there are."""

    def __init__(self, files: TokenFiles, spark: SparkSession) -> None:
        self._store, self._path = filesystem(files.folder)
        self._shards = {r["shard"]: r["file"] for r in files.shards.collect()}
        self._parts = {r["part"]: r["file"] for r in files.parts.collect()}
        self._files, self._spark, self._indexes = files, spark, {}

    def get(self, doc_id, copy: int = 0) -> np.ndarray | None:
        """The ids of a document; None if there is no such key."""
        key = self._spark.createDataFrame([(doc_id, copy)], f"doc_id {self._files.id_kind}, copy int")
        part = _with_part(key, self._files.n_parts).first()["part"]
        if part not in self._parts:
            return None
        if part not in self._indexes:
            with self._store.open_input_file(f"{self._path}/{self._parts[part]}") as file:
                self._indexes[part] = Index(file.read())
        slots, known = self._indexes[part].find(np.array([key_hash(doc_id, copy)], np.uint64))
        if not known[0]:
            return None
        with self._store.open_input_file(f"{self._path}/{self._shards[int(slots['shard'][0])]}") as file:
            _, width, _ = struct.unpack(_SHARD, file.read(_SHARD_BYTES))
            file.seek(_SHARD_BYTES + int(slots["offset"][0]) * width)
            return np.frombuffer(file.read(int(slots["length"][0]) * width), f"<u{width}").astype("<u4")
