"""Token ids as Parquet list columns: an ordered, selectively readable store.

Documents are dealt by range of the id and sorted, so file after file holds ascending ids.
Each row has id, part (the file's number), local_start (ids of the part's rows before it),
n_tokens and tokens. Row groups are small, page indexes are written (the writer always
does), token ids are dictionary-encoded and the sorted metadata columns delta-encoded, so a
reader of metadata or of an id range fetches only those pages. ``start`` over the whole
store is the part's offset (a sum over the parts before, one row a part) plus local_start.

Encoding goes word by word: the tokenizer's pre-tokens never cross ASCII white space, so a
text's ids are its words' ids in order. Words seen before come from a bounded memory.

Defined cases: null text is empty and has the end id alone; null ids come first; rows of
equal id follow one another by the hash of their text; an empty table gives an empty store.
Only the named columns are read.
"""

from __future__ import annotations

import gc
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import small_batches

#: The writer's properties. Version 2 pages have delta encodings and page indexes.
WRITER = {
    "parquet.writer.version": "PARQUET_2_0", "parquet.block.size": str(16 << 20), "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000", "parquet.enable.dictionary": "false", "parquet.enable.dictionary#tokens.list.element": "true",
    "parquet.dictionary.page.size": str(1 << 20), "compression": "zstd",
}


@dataclass(frozen=True)
class TokenSpec:
    """``tokenizer``: path of the tokenizer's file; ``end_id`` follows each document.

    ``memory_words``: words and stems a worker remembers, about 250 bytes each; ``rows_per_part``
    bounds a part beside the session's number of shuffle partitions.
    """

    tokenizer: str
    end_id: int = 2
    memory_words: int = 450_000
    rows_per_part: int = 100_000


#: Marks that one pre-token holds together behind letters. Apostrophes begin contractions, and angle brackets special tokens.
TAIL = ".,!?;:%$#*&|()-+=/_~"


class WordEncoder:
    """Ids of whole texts, through the tokenizers library.

    A plain word (letters below U+0130, then marks of TAIL) is put together from its
    lower-cased stem and its tail, as the tokenizer lower-cases and splits there; stems go to
    the library many at a time, past the steps of its pipeline that can't change them.
    """

    def __init__(self, path: str, memory_words: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the executor's cores already have a task each
        from tokenizers import Tokenizer, pre_tokenizers

        whole = Tokenizer.from_file(path)
        self.encode = whole.encode_batch_fast
        plain = Tokenizer(whole.model)  # the same vocabulary and merges, held once
        plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.encode_plain = plain.encode_batch_fast
        vocab = whole.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.room = memory_words

    def _any(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.encode(words, add_special_tokens=False)]

    def _stems(self, stems: list[str]) -> list[bytes]:
        """Ids of lower-case words of letters, encoded many to a text: each is one pre-token,
        and the last of its ids is the only one that ends a word."""
        out = []
        for got in self.encode_plain([" ".join(stems[i : i + 500]) for i in range(0, len(stems), 500)], add_special_tokens=False):
            ids = np.array(got.ids, "<u4")
            raw, stops = ids.tobytes(), (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            out += [raw[a:b] for a, b in zip([0, *stops], stops)]  # noqa: B905
        return out

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words not yet known. While there is room, stems are remembered, and whole words up to half of it."""
        known, found, waiting, odd, tails = self.known, {}, [], [], {}
        for w in words:
            low = w.lower()
            stem = low.rstrip(TAIL)
            if stem.isalpha() and (w.isascii() or max(w) < "İ"):
                tail = low[len(stem) :]
                if tail and tail not in tails:
                    tails[tail] = self._any([tail])[0]
                if (ids := known.get(stem)) is not None:
                    found[w] = ids + tails[tail] if tail else ids
                else:
                    waiting.append((w, stem, tail))
            else:
                odd.append(w)
        fresh = list({s for _, s, _ in waiting})
        new = dict(zip(fresh, self._stems(fresh), strict=True))
        for w, stem, tail in waiting:
            found[w] = new[stem] + tails[tail] if tail else new[stem]
        found.update(zip(odd, self._any(odd), strict=True))
        if len(known) < self.room:
            known.update(new)
        if len(known) < self.room // 2:
            known.update(found)
        return found

    def __call__(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one behind the other, each with the end id; where each text's ids begin, and the end).

        Arrow splits the texts and numbers their distinct words; Python sees each of those
        once, and numpy lays out the ids.
        """
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        collecting = gc.isenabled()
        gc.disable()  # strings and bytes by the hundred thousand, and no cycles
        try:
            ids = list(map(self.known.get, words))
            gaps = [i for i, x in enumerate(ids) if x is None]
            if gaps:
                found = self._learn({words[i] for i in gaps})
                for i in gaps:
                    ids[i] = found[words[i]]
        finally:
            if collecting:
                gc.enable()
        # The end id is one more word, behind the last word of each text.
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64)
        place = np.insert(coded.indices.to_numpy(), ends, len(ids))
        ids.append(np.array([end_id], "<u4").tobytes())
        size = np.fromiter(map(len, ids), np.int32, len(ids)) >> 2
        pool, first = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size, dtype=np.int32) - size
        own = size[place]
        upto = np.zeros(len(own) + 1, np.int32)
        np.cumsum(own, out=upto[1:])
        at = np.repeat(first[place] - upto[:-1], own)
        at += np.arange(upto[-1], dtype=np.int32)
        return pool[at], upto[np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])].astype(np.int64)


@lru_cache(maxsize=1)
def worker_encoder(path: str, memory_words: int) -> WordEncoder:
    """The encoder of this Python worker: what it has learned serves all tasks that the worker runs."""
    return WordEncoder(path, memory_words)


def write_tokens(docs: DataFrame, path: str, spec: TokenSpec, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the store to ``path``, a folder that the executors share."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // spec.rows_per_part))
    dealt = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("__text"))
    dealt = dealt.withColumn("part", F.spark_partition_id())
    kind = docs.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, at = worker_encoder(spec.tokenizer, spec.memory_words), 0
        for b in batches:
            ids, stops = words(b.column("__text"), spec.end_id)
            tokens = pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(ids.view("<i4")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), pa.array(at + stops[:-1]), pa.array(np.diff(stops)), tokens],
                                             ["doc_id", "part", "local_start", "n_tokens", "tokens"])
            at += int(stops[-1])

    out = dealt.mapInArrow(encode, f"doc_id {kind}, part int, local_start long, n_tokens long, tokens array<int>")
    with small_batches(spark, 1024):
        out.write.options(**WRITER).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, tokens; columns that aren't selected aren't read."""
    store = spark.read.parquet(path)
    sizes = store.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # one row a part
    ends = np.cumsum([r["n"] for r in sizes]).tolist() if sizes else []
    offsets = spark.createDataFrame([(r["part"], e - r["n"]) for r, e in zip(sizes, ends, strict=True)], "part int, offset long")
    return store.join(F.broadcast(offsets), "part", "left").select("doc_id", (F.col("offset") + F.col("local_start")).alias("start"), "n_tokens", "tokens")


def with_crc(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32: the CRC-32 of all ids as little-endian unsigned 32-bit integers."""
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("tokens")
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            at = lists.offsets.to_numpy()
            crc = [zlib.crc32(values[i:j].tobytes()) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(crc, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(digest, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
