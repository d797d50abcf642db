"""Token-id files with keyed access through a minimal perfect hash.

Layout below one folder, all of it Spark tables, so any store will do:

* `chunks`: (shard, chunk, first, doc_ids, offsets, lengths, payload).  `payload`
  is raw little-endian ids of whole documents in a row (16-bit if the vocabulary
  allows, else 32-bit), `first` the ids of the shard before it, `offsets` and
  `lengths` count ids within the payload.  Shards and chunks ascend by doc_id.
* `shards`: (shard, base, n_tokens), `base` being the ids of all shards before.
* `index`: one row per bucket of keys: levels of a perfect hash and, by slot,
  32-bit fingerprints, shard, chunk, offset and length.  It is partitioned by
  `part` (bucket modulo at most `INDEX_PARTS`), so keys read the parts they need.

`lookup` hashes a key to its bucket, finds its slot in a few probes, checks the
fingerprint, and so knows where the document's ids lie without any search.
`fetch` reads the chunks named there and slices the payload; the doc_id stored at
that place must be the key.

Documents are sorted by range, so shards are of even size; chunks close after
`CHUNK_IDS` ids, and a document is never cut: a longer one has a chunk of its own.
Buckets hold about `BUCKET_KEYS` keys whatever the number of documents.

Defined results: a null or empty text has no ids but the end id, a text of any
length is one document; an unknown key is not found (by `lookup` alone: but for a
fingerprint of 32 bits equal by chance); of repeated doc_ids the index points to
the first row stored, `report` takes the others from the stored doc_ids; a null
doc_id is stored first and not indexed; an empty table gives empty files; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import codecs
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kinfold.llm import arrow_text, perfect_hash
from kinfold.llm.arrow_text import process_state
from kinfold.llm.bpe import byte_symbols
from kinfold.session import materialize

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
CHUNK_IDS = 1 << 18
BUCKET_KEYS = 1 << 16
INDEX_PARTS = 256
#: Up to so many shards a read names them to the scan; the rows are the same either way.
NAMED_SHARDS = 1000
CACHE_PIECES = 200_000
SLICE_BYTES = 4 << 20
BLOCK_PIECES = 1 << 14

_CHUNKS = ("shard int, chunk int, first long, doc_ids array<long>, offsets array<long>, lengths array<long>, payload binary")
_INDEX = ("bucket int, levels array<binary>, ranks array<binary>, fingerprints binary, shards binary, chunks binary, offsets binary, lengths binary")

#: A space or line break with other than white space on both sides: no token of the byte-level pattern crosses its left edge.
#: The space goes, the line break stays with the piece behind it.
_CUT = re.compile(r"(?<=\S) (?=\S)|(?<=\S)(?=\n\S)")
#: The line breaks of these, in texts without wide white space.
_LINE = r"([^\s\x0b\x1c-\x1f])\n([^\s\x0b\x1c-\x1f])"
#: Latin letters, and marks that the byte-level pattern never joins to the letters before them.
_LETTER = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]"
_MARK = r"[!#$%&*,.:;?]"
_LONE = "^ | $|[\\s\\x0b\\x1c-\\x1f] | [\\s\\x0b\\x1c-\\x1f]"
_WIDE = "[\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def id_type(tokenizer: str) -> str:
    """The smallest type for the vocabulary's ids."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"


def gathered(flat: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the pieces `at` in a row, and the number of ids of each; `flat` holds those of all pieces."""
    n = lengths[at]
    starts = (np.cumsum(lengths) - lengths)[at] - (np.cumsum(n) - n)
    return flat[np.repeat(starts, n) + np.arange(int(n.sum()))], n


class PieceEncoder:
    """Ids of text pieces by the tokenizers library, remembering those seen.

    Letters of `_LETTER` with at most one space before them are one pre-token of the byte-level pattern, and marks of
    `_MARK` behind them up to the next white space are the next one, so a marked piece has the ids of its two parts.
    Ids of letters come from a tokenizer of the same model, to which many go in one text of byte symbols.
    Pieces and ids stay Arrow and numpy arrays; only parts not seen before become Python strings, a block at a time.
    """

    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.library, self.dtype = Tokenizer.from_file(path), dtype
        self.library.no_truncation()
        self.library.no_padding()
        self.seen, self.flat, self.lengths = pa.array([], pa.large_string()), np.zeros(0, dtype), np.zeros(0, np.int64)
        spec = json.loads(self.library.to_str())
        self.letters = None
        split, model = spec["pre_tokenizer"] or {}, spec["model"]
        if (split.get("type"), split.get("use_regex"), split.get("add_prefix_space"), spec["normalizer"], model["type"]) == (
                "ByteLevel", True, False, None, "BPE") and not (model["dropout"] or model["continuing_subword_prefix"] or model["end_of_word_suffix"]):
            merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
            # What was seen is remembered here, so the model need not.
            self.letters = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0, ignore_merges=model["ignore_merges"]))
            self.symbols = "".join(byte_symbols())
            self.letters.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(self.symbols[ord("\n")])
            self.n_bytes = np.zeros(max(model["vocab"].values()) + 1, np.int64)
            for token, i in model["vocab"].items():
                self.n_bytes[i] = len(token)

    def _coded(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts in a row, and the number of ids of each."""
        ids, lengths = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for start in range(0, len(parts), BLOCK_PIECES):
            block = parts.slice(start, BLOCK_PIECES).to_pylist()
            coded = self.library.encode(block, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(coded.ids, self.dtype))
            lengths.append(np.bincount(np.array(coded.word_ids, np.int64), minlength=len(block)))
        return np.concatenate(ids), np.concatenate(lengths)

    def _coded_letters(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts of letters, which no line break is in; tokens are told apart by their bytes."""
        ids, lengths = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for start in range(0, len(parts), BLOCK_PIECES):
            block = parts.slice(start, BLOCK_PIECES)
            raw = "\n".join(block.to_pylist()).encode()
            found = np.array(self.letters.encode_batch_fast([codecs.charmap_decode(raw, "strict", self.symbols)[0]], add_special_tokens=False)[0].ids, self.dtype)
            ends, done = np.cumsum(pc.binary_length(block).to_numpy(zero_copy_only=False)), np.cumsum(self.n_bytes[found])
            last = np.searchsorted(done, ends)
            if len(done) == 0 or done[-1] != ends[-1] or (done[last] != ends).any():
                raise ValueError("the tokens do not spell the pieces")
            ids.append(found)
            lengths.append(np.diff(last, prepend=-1))
        return np.concatenate(ids), np.concatenate(lengths)

    def _new(self, parts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The parts, those of letters first, their ids, and the number of ids of each."""
        if self.letters is None:
            return parts, *self._coded(parts)
        plain = pc.match_substring_regex(parts, rf"\A ?{_LETTER}+\z")
        groups = [parts.filter(plain), parts.filter(pc.invert(plain))]
        ids, lengths = zip(self._coded_letters(groups[0]), self._coded(groups[1]))
        return pa.concat_arrays(groups), np.concatenate(ids), np.concatenate(lengths)

    def _parts(self, pieces: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Distinct parts, the empty one first, and the places of each piece's two parts."""
        heads, tails = pieces, pa.array([""], pa.large_string()).take(pa.array(np.zeros(len(pieces), np.int64)))
        if self.letters is not None:
            split = pc.extract_regex(pieces, rf"\A(?P<head> ?{_LETTER}+)(?P<tail>{_MARK}+)\z")
            heads, tails = pc.coalesce(pc.struct_field(split, "head"), pieces), pc.coalesce(pc.struct_field(split, "tail"), tails)
        coded = pc.dictionary_encode(pa.concat_arrays([pa.array([""], pa.large_string()), heads, tails]))
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)[1:].reshape(2, -1).T

    def ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the distinct pieces in a row, and the number of ids of each."""
        parts, places = self._parts(pieces)
        at = pc.index_in(parts, self.seen)
        seen, flat, lengths = self.seen, self.flat, self.lengths
        if at.null_count:
            found, new_ids, new_lengths = self._new(parts.filter(at.is_null()))
            flat, lengths = np.concatenate([flat, new_ids]), np.concatenate([lengths, new_lengths])
            at = pc.coalesce(at, pc.add(pc.index_in(parts, found), pa.scalar(len(seen), pa.int32())))
            room = min(CACHE_PIECES - len(seen), len(found))
            if room > 0:  # the early parts are the frequent ones
                self.seen, self.lengths = pa.concat_arrays([seen, found.slice(0, room)]), lengths[:len(seen) + room].copy()
                self.flat = flat[:self.lengths.sum()].copy()
        at = at.to_numpy(zero_copy_only=False)
        ids, n = gathered(flat, lengths, at[places.ravel()])
        return ids, n.reshape(-1, 2).sum(axis=1)


def pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct pieces, each piece's code, and the text it is of; a piece but the first has its space or line break before it.

    Texts are cut before lone spaces and line breaks only, so the ids of the pieces in a row are the ids of the text.
    """
    odd = pc.or_(pc.match_substring_regex(texts, _LONE), pc.match_substring_regex(texts, _WIDE))
    lists = pc.split_pattern(pc.replace_substring_regex(texts.filter(pc.invert(odd)), _LINE, "\\1 \n\\2"), " ")
    if len(lists) < len(texts):
        by_hand = pa.array([_CUT.split(t) for t in texts.filter(odd).to_pylist()], lists.type)
        order = np.argsort(np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
        lists = pa.concat_arrays([lists, by_hand]).take(pa.array(order))
    split = arrow_text.listed(lists)
    first = np.ones(len(split.codes), bool)
    first[1:] = split.rows[1:] != split.rows[:-1]
    heads, head_at = np.unique(split.codes[first], return_inverse=True)
    inner = np.flatnonzero(np.bincount(split.codes[~first], minlength=len(split.distinct)))
    place = np.zeros(len(split.distinct), np.int64)
    place[inner] = np.arange(len(inner))
    codes = place[split.codes]
    codes[first] = len(inner) + head_at
    words = split.distinct.cast(pa.large_string())
    behind = words.take(pa.array(inner))
    spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), behind, pa.scalar("", pa.large_string()))
    return pa.concat_arrays([pc.if_else(pc.starts_with(behind, "\n"), behind, spaced), words.take(pa.array(heads))]), codes, split.rows


def encoded(texts: pa.Array, tokenizer: str, dtype: str, end_id: int) -> Iterator[np.ndarray]:
    """Ids of each text, the end id last."""
    encoder = process_state(("pieces", tokenizer, dtype), lambda: PieceEncoder(tokenizer, dtype))
    end = np.array([end_id], dtype)
    for _, some in arrow_text.slices(texts, SLICE_BYTES):
        distinct, codes, rows = pieces(some)
        ids, n = gathered(*encoder.ids(distinct), codes)
        ends = np.cumsum(np.bincount(rows, n, len(some)).astype(np.int64))
        start = 0
        for stop in ends.tolist():
            yield np.concatenate([ids[start:stop], end])
            start = stop


def _chunk_writer(tokenizer: str, dtype: str, end_id: int, chunk_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk, first = TaskContext.get().partitionId(), 0, 0
        keys, held, n_held = [], [], 0
        schema = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                            ("offsets", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())])

        def closed() -> pa.RecordBatch:
            lengths = np.array([len(h) for h in held], np.int64)
            row = [shard, chunk, first, keys, np.cumsum(lengths) - lengths, lengths, np.concatenate(held).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for key, coded in zip(ids, encoded(batch.column("text"), tokenizer, dtype, end_id)):
                if held and n_held + len(coded) > chunk_ids:
                    yield closed()
                    chunk, first, keys, held, n_held = chunk + 1, first + n_held, [], [], 0
                keys.append(key)
                held.append(coded)
                n_held += len(coded)
        if held:
            yield closed()
    return run


def _bucket_of(key):
    """Bucket hash of a key; independent of the hashes inside a bucket."""
    return F.xxhash64(F.lit(7), key)


def _index_builder(batches: pa.Table) -> pa.Table:
    keys = batches.column("key").to_numpy()
    levels = perfect_hash.build(keys)
    slot = perfect_hash.slots(levels, keys)

    def by_slot(values: np.ndarray, dtype: str) -> bytes:
        out = np.zeros(len(keys), dtype)
        out[slot] = values
        return out.tobytes()
    column = lambda name, dtype: by_slot(batches.column(name).to_numpy(), dtype)
    row = {"bucket": batches.column("bucket")[0].as_py(), "levels": [b for b, _ in levels], "ranks": [r for _, r in levels],
           "fingerprints": by_slot(perfect_hash.fingerprints(keys), "<u4"), "shards": column("shard", "<i4"),
           "chunks": column("chunk", "<i4"), "offsets": column("offset", "<i8"), "lengths": column("length", "<i8")}
    return pa.Table.from_pylist([row], pa.schema([
        ("bucket", pa.int32()), ("levels", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary())),
        *[(n, pa.binary()) for n in list(row)[3:]]]))


def entries(chunks: DataFrame) -> DataFrame:
    """(key, shard, chunk, offset, length) of every stored document; the payload is not read."""
    return chunks.select("shard", "chunk", F.inline(F.arrays_zip(
        F.col("doc_ids").alias("key"), F.col("offsets").alias("offset"), F.col("lengths").alias("length"))))


def write(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
          end_id: int = END_ID) -> None:
    """Encode and write the files, then their index."""
    spark, dtype = docs.sparkSession, id_type(tokenizer)
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(_chunk_writer(tokenizer, dtype, end_id, CHUNK_IDS), _CHUNKS).write.parquet(f"{path}/chunks")
    chunks = read_chunks(spark, path)
    totals = chunks.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n_tokens"))
    # One row per shard, that is per task of the sort.
    running = F.sum("n_tokens").over(Window.orderBy("shard")) - F.col("n_tokens")
    totals.select("shard", running.alias("base"), "n_tokens").write.parquet(f"{path}/shards")
    stored = (entries(chunks).filter("key IS NOT NULL").groupBy("key")
              .agg(F.min(F.struct("shard", "chunk", "offset", "length")).alias("at")).select("key", "at.*"))
    n_buckets = max(1, -(-chunks.agg(F.sum(F.size("doc_ids"))).first()[0] // BUCKET_KEYS)) if not chunks.isEmpty() else 1
    bucketed = stored.withColumn("bucket", F.pmod(_bucket_of(F.col("key")), F.lit(n_buckets)).cast("int"))
    index = bucketed.groupBy("bucket").applyInArrow(_index_builder, _INDEX).withColumn("n_buckets", F.lit(n_buckets))
    index.withColumn("part", _part(n_buckets)).repartition("part").write.partitionBy("part").parquet(f"{path}/index")


def _part(n_buckets: int):
    return F.col("bucket") % F.lit(min(n_buckets, INDEX_PARTS))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_CHUNKS).parquet(f"{path}/chunks")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{_INDEX}, n_buckets int, part int").parquet(f"{path}/index")


def _finder(index: pa.Table, keys: pa.Table) -> pa.Table:
    wanted = keys.column("key").to_numpy()
    schema = pa.schema([("key", pa.int64()), ("shard", pa.int32()), ("chunk", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])
    if not index.num_rows or not len(wanted):
        return schema.empty_table()
    row = index.slice(0, 1).to_pylist()[0]
    slot = perfect_hash.slots(list(zip(row["levels"], row["ranks"])), wanted)
    known = np.frombuffer(row["fingerprints"], "<u4")
    hit = slot >= 0
    hit[hit] = known[slot[hit]] == perfect_hash.fingerprints(wanted[hit])
    at = slot[hit]
    values = [np.frombuffer(row[n], d)[at] for n, d in (("shards", "<i4"), ("chunks", "<i4"), ("offsets", "<i8"), ("lengths", "<i8"))]
    return pa.Table.from_arrays([pa.array(wanted[hit]), *map(pa.array, values)], schema=schema)


def lookup(spark: SparkSession, path: str, keys: DataFrame, key: str = "key") -> DataFrame:
    """(key, shard, chunk, offset, length) of each distinct key that the files hold, from the index parts of these keys."""
    index = read_index(spark, path)
    first = index.select("n_buckets").first()
    n_buckets = first["n_buckets"] if first else 1
    wanted = keys.select(F.col(key).cast("long").alias("key")).filter("key IS NOT NULL").distinct()
    wanted = wanted.withColumn("bucket", F.pmod(_bucket_of(F.col("key")), F.lit(n_buckets)).cast("int"))
    parts = [r[0] for r in wanted.select(_part(n_buckets)).distinct().collect()]  # INDEX_PARTS at most
    return index.filter(F.col("part").isin(parts)).groupBy("bucket").cogroup(wanted.groupBy("bucket")).applyInArrow(
        _finder, "key long, shard int, chunk int, offset long, length long")


def _slices(dtype: str, ids: bool):
    """The asked places of each chunk: their ids or the crc of these."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                shard, chunk, first, keys, offsets, payload, asked = (c[at].as_py() for c in batch.columns)
                stored, held = dict(zip(offsets, keys)), np.frombuffer(payload, dtype)
                asked = [a for a in asked if a["offset"] in stored and stored[a["offset"]] == a["key"]]
                here = [held[a["offset"]:a["offset"] + a["length"]].astype("<u4").tobytes() for a in asked]
                n = len(asked)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a["key"] for a in asked], pa.int64()), pa.array([shard] * n, pa.int32()), pa.array([chunk] * n, pa.int32()),
                     pa.array([a["offset"] for a in asked], pa.int64()), pa.array([first + a["offset"] for a in asked], pa.int64()),
                     pa.array([len(h) // 4 for h in here], pa.int64()),
                     pa.array(here, pa.binary()) if ids else pa.array([zlib.crc32(h) for h in here], pa.int64())],
                    ["key", "shard", "chunk", "offset", "in_shard", "n_tokens", "ids" if ids else "ids_crc32"])
    return run


def read_places(spark: SparkSession, path: str, places: DataFrame, tokenizer: str = TOKENIZER, ids: bool = True) -> DataFrame:
    """(key, shard, chunk, offset, start, n_tokens, ids as little-endian unsigned 32-bit) at (key, shard, chunk, offset, length).

    A place that does not hold the key is left out.  Without `ids` their crc is returned as ids_crc32.
    """
    asked = places.groupBy("shard", "chunk").agg(F.collect_list(F.struct("key", "offset", "length")).alias("asked"))
    chunks = read_chunks(spark, path)
    named = [r[0] for r in places.select("shard").distinct().limit(NAMED_SHARDS + 1).collect()]
    if len(named) <= NAMED_SHARDS:
        chunks = chunks.filter(F.col("shard").isin(named))
    met = chunks.select("shard", "chunk", "first", "doc_ids", "offsets", "payload").join(asked, ["shard", "chunk"])
    held = met.mapInArrow(_slices(id_type(tokenizer), ids), "key long, shard int, chunk int, offset long, in_shard long, n_tokens long, "
                          + ("ids binary" if ids else "ids_crc32 long"))
    base = spark.read.schema("shard int, base long, n_tokens long").parquet(f"{path}/shards").select("shard", "base")
    return held.join(base, "shard").withColumn("start", F.col("base") + F.col("in_shard")).drop("base", "in_shard")


def fetch(spark: SparkSession, path: str, keys: DataFrame, key: str = "key", tokenizer: str = TOKENIZER) -> DataFrame:
    """The ids of each distinct key that the files hold, read where the index says; columns as in `read_places`."""
    return read_places(spark, path, materialize(lookup(spark, path, keys, key), "token-places"), tokenizer)


def followers(chunks: DataFrame) -> DataFrame:
    """Places of the rows that the index does not name: null doc_ids, and repeats behind the first."""
    stored, at = entries(chunks), F.struct("shard", "chunk", "offset")
    repeated = (stored.filter("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"), F.min(at).alias("named"))
                .filter("n > 1").select("key", "named"))
    behind = stored.join(repeated, "key").filter(at > F.col("named")).drop("named")
    return stored.filter("key IS NULL").unionByName(behind)


def report(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """Write the files, look every document up by its key, and return what the payload holds where the index says.

    Rows of a repeated doc_id behind the first, and those without a doc_id, come from the stored doc_ids.
    """
    spark = docs.sparkSession
    write(docs, path, doc_id, text, tokenizer)
    places = lookup(spark, path, docs, doc_id).unionByName(followers(read_chunks(spark, path)))
    held = read_places(spark, path, materialize(places, "token-places"), tokenizer, ids=False)
    return held.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32", "shard", "chunk", "offset")
