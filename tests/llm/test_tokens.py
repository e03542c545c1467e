import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from loadkit.llm import tokens
from loadkit.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm.helpers import ODD, no_docs, odd_docs

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_query_against_the_library(spark, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    want = {(r.doc_id, len(r.text.encode()), len(library.encode(r.text)), len(library.encode(r.text)) > 4096) for r in docs}
    assert {tuple(r) for r in QUERIES["op6_token_counts"](spark, DATA).collect()} == want


def test_odd_rows(spark, library):
    got = sorted((tuple(r) for r in tokens.count_tokens(odd_docs(spark), PATH, limit=100).collect()), key=repr)
    counts = [(d, len((t or "").encode()), len(library.encode(t or ""))) for d, t in ODD]
    assert got == sorted(((*c, c[2] > 100) for c in counts), key=repr)
    assert tokens.count_tokens(no_docs(spark), PATH).collect() == []


TEXTS = st.lists(st.sampled_from(["a", "the", "ing", " ", "  ", "   ", "\n", "é", "日本", "\U0001f600", "▁", "<s>", "0", "\x00", "er", "th", "x" * 50]), max_size=30).map("".join)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 9))
def test_chunks_compose_to_the_whole(text, chunk):
    machine = tokens.transducer(PATH)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert machine.of_long_text(text.replace("▁", " ").encode(), chunk) == len(library.encode(text))


def test_composition_is_associative():
    machine = tokens.transducer(PATH)
    maps = [machine.chunk_map(c) for c in (b" ab", b"c  d", b" ", b"ef g", b"", b" h ")]
    for a, b, c in zip(maps, maps[1:], maps[2:], strict=False):
        assert machine.compose(machine.compose(a, b), c) == machine.compose(a, machine.compose(b, c))


def test_kept_transitions_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "MOST_KEPT", 10)
    machine = tokens.Transducer(PATH)
    for i in range(30):
        machine.chunk_map(b" ".join(b"w%d" % (i * 10 + j) for j in range(6)))
    assert sum(len(k) for k, _ in machine.runs) <= 10
