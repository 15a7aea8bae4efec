import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paperloom.llm import token_files
from paperloom.llm.queries import tokenizer_file
from paperloom.llm.token_files import TokenFile, WordEncoder, digest_tokens, read_parts, read_tokens, write_tokens
from paperloom.staging import stage_path

PATH = tokenizer_file("byte_bpe_50k.json")


def library():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def test_remembered_words_give_the_same_ids(monkeypatch):
    monkeypatch.setattr(token_files, "MEMO", 50)
    rnd, own, whole = random.Random(1), WordEncoder(PATH), library()
    parts = [" ", "  ", "\n", "\t", "a", "it's", "'s", "don't", "12", "!", "é", "\xa0", "中文", "<|endoftext|>", "\r\n", "X", ".", "\u3000", "\x85", "\x1c", "x" * 60]
    for _ in range(3000):
        texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))) for _ in range(3)]
        got = [np.frombuffer(b, "<u2").tolist() for b in own.encode(texts)]
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts], texts
    assert len(own.memo) <= 100


def test_files_read_back(spark, odd):
    docs = odd.withColumn("PART", F.lit(0)).withColumn("_h", F.lit(0))
    folder = stage_path(spark, "tokens")
    parts = write_tokens(docs, folder, PATH, partitions=4)
    whole = library()
    want = sorted(((r["doc_id"], whole.encode(r["text"] or "", add_special_tokens=False).ids + [0]) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    rows = sorted(read_tokens(parts, "<u2").collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [d for d, _ in want]
    assert sorted((str(r["doc_id"]), r["ids"]) for r in rows) == sorted((str(d), i) for d, i in want)
    starts = np.cumsum([0] + [r["n_tokens"] for r in rows])
    assert [r["start"] for r in rows] == starts[:-1].tolist() and all(len(r["ids"]) == r["n_tokens"] for r in rows)
    digests = {(r["start"], r["ids_crc32"]) for r in digest_tokens(read_parts(spark, folder), "<u2").collect()}
    assert digests == {(r["start"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in rows}
    # laid end to end the files are one array, cut by the offsets
    named = sorted(parts.collect(), key=lambda r: r["part"])
    flat = np.concatenate([TokenFile(r["ids"], "<u2").slice(0, r["n_tokens"]) for r in named])
    assert flat.tolist() == [i for r in rows for i in r["ids"]]
    offsets = [TokenFile(r["offsets"], "<u8").slice(0, r["n_docs"] + 1).tolist() for r in named]
    assert all(a[-1] == b[0] for a, b in zip(offsets, offsets[1:])) and offsets[-1][-1] == len(flat)


def test_empty_table(spark, none):
    parts = write_tokens(none, stage_path(spark, "tokens"), PATH)
    assert parts.count() == 0 and read_tokens(parts, "<u2").count() == 0


def test_added_tokens_in_texts(spark):
    """Ids are those of the untouched tokenizer, wherever an added token stands."""
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>  y <|endoftext|>", "no <|endoftext| here", "plain words", "<|endoftext|><|endoftext|> 12"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    whole = Tokenizer.from_file(PATH)
    rows = read_tokens(write_tokens(docs, stage_path(spark, "tokens"), PATH), "<u2").collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == {i: whole.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    rnd, own = random.Random(2), WordEncoder(PATH, added_as_text=False)
    parts = [" ", "  ", "\n", "a", "it's", "12", "é", "<|endoftext|>", "<|", "|>", "中文", "."]
    for _ in range(1000):
        some = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))) for _ in range(3)]
        assert [np.frombuffer(b, "<u2").tolist() for b in own.encode(some)] == [whole.encode(t, add_special_tokens=False).ids for t in some], some


def test_folders_are_those_of_spark(spark, tmp_path):
    """A path without a scheme is one of Spark's default file system, and files are named by their full URI."""
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    parts = write_tokens(docs, f"{tmp_path}/plain", PATH)
    assert all(r[c].startswith(f"file:{tmp_path}/plain/") for r in parts.collect() for c in ("ids", "offsets", "docs"))
    assert sorted(r["n_tokens"] for r in read_tokens(read_parts(spark, f"{tmp_path}/plain"), "<u2").collect()) == [1, 3]


def test_tokenizers_with_another_rule_get_whole_texts(tmp_path):
    import json

    stated = json.loads(open(PATH).read())
    texts = ["The Quick  brown", "an É apple 12.5", " x", "", "don't STOP"]
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {**stated["pre_tokenizer"], "add_prefix_space": True}}):
        path = f"{tmp_path}/changed.json"
        with open(path, "w") as out:
            json.dump({**stated, **change}, out)
        whole = Tokenizer.from_file(path)
        got = [np.frombuffer(b, "<u2").tolist() for b in WordEncoder(path, added_as_text=False).encode(texts)]
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_runs_of_white_space_are_found_as_by_their_definition():
    """A blank after white space that no other sign follows, whatever the texts; added tokens are found as they are."""
    import itertools
    import re

    from paperloom.llm import token_files

    stated = re.compile(r"\s (?!\S)")
    for n in range(7):
        for signs in itertools.product(" \n a", repeat=n):
            text = "".join(signs)
            assert bool(token_files._INSIDE_RUN.search(text)) == bool(stated.search(text)), repr(text)


def test_equal_words_of_texts_are_looked_up_once():
    """However often a word stands in the texts encoded at once, it is looked up and encoded once."""
    asked = []

    class Counted(dict):
        def get(self, word, *other):
            asked.append(word)
            return super().get(word, *other)

    own, whole = WordEncoder(PATH, added_as_text=False), Tokenizer.from_file(PATH)
    own.memo = Counted()
    texts = ["the cat, the dog; the cat. naïve 12", "a dog", "dog", "", " the", "the ", "a  cat the the", "a   cat", "x" * 60 + " " + "y" * 60 + "!"] * 50
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        asked.clear()
        assert [np.frombuffer(b, "<u2").tolist() for b in own.encode(texts)] == want
        # cat, the dog; cat. naïve 12 dog cat, the blank alone and the long word
        assert len(asked) <= 10, asked


def test_blocks_hold_all_texts_in_order():
    import pyarrow as pa

    rnd = random.Random(3)
    for size in (1, 10, 1 << 20):
        for n in (0, 1, 50):
            texts = ["é" * rnd.randint(0, 9) for _ in range(n)]
            got = list(token_files.blocks(pa.array(["cut off", *texts], pa.string()).slice(1), size))
            assert [t for b in got for t in b] == texts and all(b for b in got)
            assert all(len(b) == 1 or sum(len(t.encode()) for t in b) <= size for b in got)
