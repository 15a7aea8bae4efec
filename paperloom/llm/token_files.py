"""Token ids of documents as flat binary files, in ascending order of ids.

A written set is a folder: for each range of documents a file of ids (unsigned
integers, little-endian), one of offsets (64-bit, one more than there are
documents, counted over the whole set), and one of document ids (64-bit). The
table in ``parts`` names the files of each range. A range's first offset is the
sum of the tokens of all ranges before it, so the files, laid end to end, are
one array that the offsets cut up. Readers map the files into memory where the
folder is a local path.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.llm.files import opened, shared_folder
from paperloom.llm.rows import quoted
from paperloom.shipping import ship_package

# Encoded words a task remembers, twice at most, and the longest that it does.
MEMO = 400_000
MEMO_CHARS = 48
# Bytes of the texts whose words are brought together, and the texts or words handed to the library at once.
BLOCK = 8 << 20
HANDED = 64
# A null document id in the file of ids.
NO_ID = -(1 << 63)
# Ids and offsets read at once where a file cannot be mapped.
READ = 1 << 22

# A blank after white space that is not the last before something else; the search goes from blank to blank.
_INSIDE_RUN = re.compile(r" (?!\S)(?<=\s )")

# The signs that stand for bytes in a byte-level vocabulary: printable ones of
# Latin-1 for themselves, the others in order from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_SIGNS = dict(zip([b for b in range(256) if b not in _PRINTABLE], range(256, 512)))

_BLANK = chr(BYTE_SIGNS[32])

# Letters at the start of a word, and what no longer belongs to them.
_LETTERS_END = re.compile(r"([^\W\d_]+)([^\w].*)", re.DOTALL)

_PARTS = "part int, ids string, offsets string, docs string, n_docs bigint, n_tokens bigint"


class WordEncoder:
    """Ids of whole texts by a byte-level BPE of the tokenizers library.

    Such a tokenizer, with the splitting rule of its kind and no normaliser,
    cuts a text before every blank, save blanks inside a run of white space, so ids of a word with its blank do not depend on what stands
    around it, and are remembered. Texts that hold such a run are handed over
    whole, and all texts where the file states another rule or a normaliser.

    Added tokens that stand in a text, such as ``<|endoftext|>``, are text like
    any other with ``added_as_text``; without, they get their own ids as the
    library gives them, and texts that hold one are handed over whole.
    """

    def __init__(self, path: str, added_as_text: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values() if t.content and not (added_as_text and t.special)]
        if added_as_text:
            self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        self.code = "H" if id_type(self.library.get_vocab_size()) == "<u2" else "I"
        self.merges = self.library.model
        stated = json.loads(self.library.to_str())
        rule = stated["pre_tokenizer"] or {}
        self.cuts = stated["normalizer"] is None and (rule.get("type"), rule.get("add_prefix_space"), rule.get("use_regex", True)) == ("ByteLevel", False, True)
        self.direct = self.cuts and all(self._letters(w) == self._encode([" " + w])[0] for w in ("the", "Größe", "naïve", "слово", "中文"))
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        code, made = self.code, []
        for start in range(0, len(texts), HANDED):
            made += [array(code, e.ids).tobytes() for e in self.library.encode_batch_fast(texts[start : start + HANDED], add_special_tokens=False)]
        return made

    def _letters(self, word: str) -> bytes:
        """Ids of a blank and letters, which the tokenizer never cuts: straight from its merges."""
        # printable signs of ASCII stand for themselves
        spelled = _BLANK + word if word.isascii() else (" " + word).encode().decode("latin-1").translate(BYTE_SIGNS)
        return array(self.code, [t.id for t in self.merges.tokenize(spelled)]).tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words, each with its blank.

        A word is cut once more where its first letters end, as the tokenizer
        does, so that one with a full stop helps one without.
        """
        heads, cut = list(words), {}
        for i, word in enumerate(words):
            if not word.isalpha() and (m := _LETTERS_END.fullmatch(word)):
                heads[i], cut[i] = m.groups()
        found = list(map(self.memo.get, heads))
        new = {h: self.older.get(h) for h, f in zip(heads, found) if f is None}
        if self.direct:
            new.update([(h, self._letters(h)) for h, f in new.items() if f is None and h.isalpha()])
        others = [h for h, f in new.items() if f is None]
        tails = {t: self.tails.get(t) for t in cut.values()}
        new_tails = [t for t, f in tails.items() if f is None]
        made = self._encode([" " + h for h in others] + new_tails)
        new.update(zip(others, made))
        tails.update(zip(new_tails, made[len(others) :]))
        if new:
            found = [new[h] if f is None else f for h, f in zip(heads, found)]
        for i, t in cut.items():
            found[i] += tails[t]
        self._remember(new, {t: tails[t] for t in new_tails})
        return found

    def _remember(self, words: dict[str, bytes], tails: dict[str, bytes]) -> None:
        if len(self.memo) + len(words) > MEMO:  # words that come again move on from the older half
            self.older, self.memo = self.memo, {}
        if len(self.tails) + len(tails) > MEMO:
            self.tails = {}
        self.memo.update([x for x in words.items() if len(x[0]) <= MEMO_CHARS])
        self.tails.update([x for x in tails.items() if len(x[0]) <= MEMO_CHARS])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes.

        Equal words of the texts are brought together as Arrow dictionaries, so
        that each is looked up or encoded once.
        """
        if not self.cuts:
            return self._encode(texts)
        firsts, rests = [], []
        for text in texts:
            if _INSIDE_RUN.search(text) or any(a in text for a in self.added):
                first, rest = text, None
            else:
                first, blank, rest = text.partition(" ")
                rest = rest if blank else None
            firsts.append(first)
            rests.append(rest)
        split = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        laid = pa.array(self._words(words), pa.large_binary()).take(coded.indices)
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(laid).to_numpy())])
        cuts = ends[np.concatenate([[0], np.cumsum(split.value_lengths().fill_null(0).to_numpy())])].tolist()
        ids = memoryview(laid.buffers()[2] or b"")
        return [b"".join([first, ids[a:b]]) for first, a, b in zip(self._encode(firsts), cuts, cuts[1:])]


def blocks(texts: pa.Array, size: int) -> Iterator[list[str]]:
    """All texts in their order, at most ``size`` bytes of them at once, but one at least."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy())
    start = before = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield texts.slice(start, end - start).to_pylist()
        start, before = end, int(ends[end - 1])


def id_type(vocabulary: int) -> str:
    """The smallest unsigned type that holds every id."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, text: str = "text", doc_id: str = "doc_id", partitions: int | None = None
) -> DataFrame:
    """Encode whole texts and write them as token files; returns the table of parts.

    ``tokenizer`` is the path of a tokenizers file of the byte-level BPE kind
    that every executor has, ``folder`` a new folder that all can reach; without
    a scheme it is one of Spark's default file system.
    Ids are those of ``Tokenizer.encode`` without special tokens around the
    text; an added token that a text holds gets its own id. ``end_id`` follows
    every document; a null text counts as empty, so it is that id alone. Documents come in ascending order of ids, null ids first and
    kept in the file as the smallest integer; rows with one id come in order of
    a hash of their text, and may spread over several ranges. Other columns of
    ``docs`` are not read, whatever their names.

    A task writes under names of its own and only reports them when it is
    done: what a lost or repeated task leaves behind is in no table.
    """
    spark = docs.sparkSession
    ship_package(spark)
    root = shared_folder(spark, folder)
    rows = docs.select(F.col(quoted(doc_id)).cast("bigint").alias("doc_id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    tie = rows.withColumns({"_h": F.xxhash64("text"), "_s": F.pmod(F.monotonically_increasing_id(), F.lit(64))})
    order = ["doc_id", "_h", "_s"]
    ranged = tie.repartitionByRange(partitions, *order) if partitions else tie.repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions(*order).select("doc_id", "text", F.spark_partition_id().alias("part"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _word_encoder(tokenizer)
        out = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if out is None:
                part = batch.column(2)[0].as_py()
                names = [f"{root}/{part:06d}-{uuid.uuid4().hex}.{kind}" for kind in ("ids", "lengths", "docs")]
                system = opened(root)[0]
                out = [system.open_output_stream(opened(n)[1]) for n in names]
                n_docs = n_tokens = 0
            out[2].write(batch.column(0).fill_null(NO_ID).to_numpy().astype("<i8").tobytes())
            end = array(encoder.code, [end_id]).tobytes()
            lengths = []
            for texts in blocks(batch.column(1), BLOCK):
                for ids in encoder.encode(texts):
                    out[0].write(ids + end)
                    lengths.append(len(ids) // len(end) + 1)
            out[1].write(np.array(lengths, "<u8").tobytes())
            n_docs, n_tokens = n_docs + len(lengths), n_tokens + sum(lengths)
        if out is not None:
            for file in out:
                file.close()
            yield pa.RecordBatch.from_pylist([dict(part=part, ids=names[0], lengths=names[1], docs=names[2], n_docs=n_docs, n_tokens=n_tokens)], schema=_arrow(written))

    written = "part int, ids string, lengths string, docs string, n_docs bigint, n_tokens bigint"
    ranged.mapInArrow(write, written).write.parquet(f"{root}/written")
    # one row a range of documents
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = spark.read.schema(written).parquet(f"{root}/written").withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                name = f"{root}/{row['part']:06d}-{uuid.uuid4().hex}.offsets"
                system, path = opened(name)
                with system.open_input_stream(opened(row["lengths"])[1]) as source, system.open_output_stream(path) as target:
                    at = row["base"]
                    target.write(np.array([at], "<u8").tobytes())
                    while block := source.read(8 * READ):
                        ends = at + np.cumsum(np.frombuffer(block, "<u8"), dtype=np.uint64)
                        target.write(ends.astype("<u8").tobytes())
                        at = int(ends[-1])
                done.append({**row, "offsets": name})
            yield pa.RecordBatch.from_pylist(done, schema=_arrow(_PARTS))

    spread = based.repartition(max(1, spark.sparkContext.defaultParallelism), "part")
    spread.mapInArrow(offsets, _PARTS).write.parquet(f"{root}/parts")
    return read_parts(spark, root)


def read_parts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_PARTS).parquet(f"{folder.rstrip('/')}/parts")


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


@lru_cache(maxsize=1)
def _word_encoder(path: str) -> WordEncoder:
    """One for each worker process, so that tasks after each other share what it remembers."""
    return WordEncoder(path, added_as_text=False)


class TokenFile:
    """The numbers of one file: mapped into memory, or read in blocks."""

    def __init__(self, name: str, dtype: str):
        self.dtype = np.dtype(dtype)
        system, path = opened(name)
        local = isinstance(system, fs.LocalFileSystem)
        size = system.get_file_info(path).size
        self.mapped = np.memmap(path, self.dtype, "r") if local and size else None
        self.file = None if local else system.open_input_file(path)

    def slice(self, start: int, end: int) -> np.ndarray:
        if self.file is None:
            return self.mapped[start:end] if self.mapped is not None else np.zeros(0, self.dtype)
        width = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((end - start) * width, start * width), self.dtype)


def _read(parts: DataFrame, dtype: str, digest: bool) -> DataFrame:
    ship_package(parts.sparkSession)
    spark = parts.sparkSession
    schema = "doc_id bigint, start bigint, n_tokens bigint, " + ("ids_crc32 bigint" if digest else "ids array<bigint>")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, docs = TokenFile(row["ids"], dtype), TokenFile(row["offsets"], "<u8"), TokenFile(row["docs"], "<i8")
                base = int(offsets.slice(0, 1)[0])
                for first in range(0, row["n_docs"], 1000):
                    last = min(first + 1000, row["n_docs"])
                    cuts = offsets.slice(first, last + 1).astype(np.int64) - base
                    names = np.asarray(docs.slice(first, last)).astype(np.int64)
                    sets = [ids.slice(a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                    made = [zlib.crc32(x.astype("<u4").tobytes()) for x in sets] if digest else [x.astype(np.int64) for x in sets]
                    columns = [
                        pa.array(names, mask=names == NO_ID),
                        pa.array(cuts[:-1] + base),
                        pa.array(np.diff(cuts)),
                        pa.array(made, pa.int64() if digest else pa.list_(pa.int64())),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    # a range is read by one task: as many as there are, not as few as the table has files
    cores = spark.sparkContext.defaultParallelism
    return parts.repartition(4 * cores, "part").mapInArrow(read, schema)


def read_tokens(parts: DataFrame, dtype: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document of a set, read from its files."""
    return _read(parts, dtype, False)


def digest_tokens(parts: DataFrame, dtype: str) -> DataFrame:
    """As ``read_tokens``, with ``ids_crc32`` over little-endian 32-bit ids in place of them."""
    return _read(parts, dtype, True)
