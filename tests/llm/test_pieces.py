import hashlib

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.llm.pieces import Normaliser, _encoder, digest_pieces, encode_pieces, restore_spans
from paperloom.llm.queries import tokenizer_file

MODEL = tokenizer_file("piece_bpe_32k.model")
NFKC = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab é①ﬁｶﾞ株㈱  \t\nＡ́​◌İ")) | st.characters(codec="utf-8"), max_size=40))
def test_normaliser_equals_the_library(text):
    normal, low, high = Normaliser(NFKC.serialized_model_proto())(text.encode())
    assert normal.decode() == NFKC.normalize(text)
    assert len(low) == len(high) == len(normal) and (low <= high).all() and (np.diff(low) >= 0).all()


def test_alignment_of_longest_prefixes():
    normal, low, high = Normaliser(NFKC.serialized_model_proto())("aｶﾞ㈱".encode())
    assert normal.decode() == "▁aガ(株)"
    source = "aｶﾞ㈱".encode()
    assert source[low[4] : high[4]].decode() == "ｶﾞ"  # two characters became one
    assert source[low[-1] : high[-1]].decode() == "㈱"  # one became three


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60))
def test_spans_tile_the_source(text):
    encoder = _encoder(MODEL)
    ids = encoder.encode([text])[0]
    starts, ends = encoder.spans(text, ids)
    assert b"".join(text.encode()[a:b] for a, b in zip(starts, ends)) == text.encode()


def test_rows_equal_the_library(odd, none):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    df = odd.withColumn("IDS", F.lit("clash")).withColumn("_row", F.lit(1)).withColumn("_value", F.lit(1))
    out = encode_pieces(df, MODEL)
    assert out.columns == [*odd.columns, "_row", "_value", "ids", "starts", "ends", "decoded"]
    rows = out.collect()
    assert len(rows) == odd.count()
    for r in rows:
        want = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert r["ids"] == want and r["decoded"] == library.decode(want)
    pieces = restore_spans(out).filter("doc_id = 8").first()["pieces"]
    assert b"".join(bytes(p) for p in pieces).decode() == next(r["text"] for r in rows if r["doc_id"] == 8)
    digests = {(r["doc_id"], r["ids_sha256"], r["n_tokens"], r["decoded_sha256"]) for r in digest_pieces(odd, MODEL, keep=["doc_id"]).collect()}
    assert digests == {
        (r["doc_id"], hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest(), len(r["ids"]), hashlib.sha256(r["decoded"].encode()).hexdigest()) for r in rows
    }
    assert encode_pieces(none, MODEL).count() == 0
