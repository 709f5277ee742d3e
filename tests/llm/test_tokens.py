import os

import pytest
from small import documents, hard_rows

from costwatch.llm import tokens

PIECES = [("<unk>", 0.0), ("▁", -2.0), ("▁a", -2.5), ("a", -3.0), ("b", -3.0), ("ab", -6.0), ("▁ab", -5.5),
          ("ba", -5.0), ("aba", -8.0), ("c", -1.0), ("cc", -2.0), ("é", -4.0)]
BYTES = [(f"<0x{k:02X}>", -20.0) for k in range(256)]
TEXTS = ["", " ", "a", "ab", "abab aba", "  a  b ", "cc ccc cccc", "x", "xx", "axxa", "é漢é", "a\nb", "▁a▁", "abcabx yz é"]


def library(pieces, byte_fallback):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tok = Tokenizer(models.Unigram(pieces, 0, byte_fallback))
    tok.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    return tok


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_counts_of_small_vocabulary(byte_fallback):
    pieces = PIECES + (BYTES if byte_fallback else [])
    tok, counts = library(pieces, byte_fallback), tokens.SegmentCounts(pieces, byte_fallback)
    for text in TEXTS:
        assert tokens.count_text(text, counts) == len(tok.encode(text).ids), text


@pytest.mark.skipif(not os.path.exists("/opt/tokenizers/piece_bpe_32k.model"), reason="no vocabulary")
def test_counts_of_public_vocabulary(spark):
    pieces = tokens.read_pieces("/opt/tokenizers/piece_bpe_32k.model")
    tok = library(pieces, True)
    rows = [r for r in hard_rows()]
    path = "/root/testdata/sf0.001/documents.parquet"
    if os.path.exists(path):
        rows += [(r["doc_id"], r["text"], "en", "a") for r in spark.read.parquet(path).collect()]
    out = tokens.count_tokens(documents(spark, rows, extra=True), pieces).collect()
    want = sorted((str(i), len(tok.encode(t or "").ids)) for i, t, _, _ in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in out) == want


def test_empty(spark):
    assert tokens.count_tokens(documents(spark, []), PIECES).count() == 0
