"""The tree encoder against the tiktoken library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from clipcurate.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(RANKS), special_tokens={}
)
ENCODER = bpe.TextEncoder(RANKS, public_tokenizers.PATTERN)

PARTS = st.sampled_from(["a", "b", "aaaa", "the", "tion", " ", "  ", "\n", "é", "ß", "漢字", "😀", "12", "--", "'s", "\u0085", "\x1c"])


def ids_of(text):
    return np.frombuffer(ENCODER.encode(text), "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=80), st.lists(PARTS, max_size=200).map("".join)))
def test_encodes_as_the_library_and_back(text):
    assert ids_of(text) == LIBRARY.encode_ordinary(text)
    assert ENCODER.decode(ENCODER.encode(text)) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=300))
def test_tree_equals_plain_merging(piece):
    assert ENCODER.encoder.tree(piece) == ENCODER.encoder.leaf(piece)


@pytest.mark.parametrize("text", ["ab" * 20_001, "the" * 10_001, "\n" * 20_001, "é" * 9_001, "a" * 3_001])
def test_very_long_pieces(text):
    assert ids_of(text) == LIBRARY.encode_ordinary(text)


def test_nulls_empty_repeats_and_clashing_columns(spark):
    rows = [(1, None, "x"), (None, "", "y"), (2, "stop it", "z"), (2, "stop it", "z"), (3, "<|endoftext|>", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(found) == 5
    for row in found:
        ids = LIBRARY.encode_ordinary(row.text or "")
        assert row.n_tokens == len(ids)
        assert row.token_ids == np.array(ids, "<u4").tobytes()
        assert row.ids_sha256 == hashlib.sha256(row.token_ids).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()
        assert row.round_trip
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
