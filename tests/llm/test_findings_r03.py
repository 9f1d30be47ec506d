"""Round 3: terms counted in arrays, texts encoded group by group, remembered trees bounded in bytes."""

import random
import re
import sys

import pyarrow as pa

from carelake.llm import sentencepiece_bpe, treap_search


def test_terms_are_counted_like_the_expression(monkeypatch):
    r = random.Random(1)
    texts = [None, "", "a", "  a b", "é è", "x" * 300, "a " * 70, " ", "\x00z", "É0[]b"]
    texts += ["".join(r.choice("ab \n.Zé9") for _ in range(r.randint(0, 40))) for _ in range(500)]
    count = lambda a: [len(re.findall(treap_search.TERM, t or "")) for t in a.to_pylist()]
    for piece in (treap_search.PIECE, 16):
        monkeypatch.setattr(treap_search, "PIECE", piece)
        for a in (pa.array(texts), pa.array(texts).slice(3, 200), pa.array([None, None], pa.string()), pa.array([], pa.string())):
            assert treap_search.term_counts(a).tolist() == count(a)


def test_counting_terms_runs_no_regular_expression(spark, monkeypatch):
    monkeypatch.setattr(treap_search.F, "regexp_count", None)
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "c é. d"), (3, " ")], "doc_id bigint, text string")
    index = treap_search.build(docs)
    assert (index.n_docs, index.n_terms) == (2, 5)
    empty = treap_search.build(docs.limit(0))
    assert (empty.n_docs, empty.n_terms) == (0, 0)


def test_texts_are_decoded_and_encoded_group_by_group(spark, monkeypatch):
    """An Arrow batch is not held as texts and results at once."""
    texts = ["abcde", None, "fghij", "", "k", "l" * 30, "m"]
    monkeypatch.setattr(sentencepiece_bpe, "GROUP_CHARS", 10)
    assert list(sentencepiece_bpe._groups(pa.array(texts))) == [["abcde", None, "fghij"], ["", "k", "l" * 30], ["m"]]
    docs = spark.createDataFrame([(None if i == 3 else i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").coalesce(1)
    vocab = sentencepiece_bpe.load_vocabulary(spark)
    got = sentencepiece_bpe.encode(docs, vocab)
    assert all(r.lossless for r in got.collect())
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert [tuple(r) for r in sorted(sentencepiece_bpe.decode(got, vocab).collect(), key=key)] == sorted(
        [(r.doc_id, r.text) for r in docs.collect()], key=key)


def test_trees_are_bounded_in_bytes_whatever_the_chunks():
    """Few long chunks take as much as many short ones; forgetting them changes no outcome."""
    vocab = sentencepiece_bpe.Vocabulary.load()
    enc, r, most = sentencepiece_bpe.Encoder(vocab, 0.1, 7), random.Random(2), 0
    texts = [" ".join("".join(r.choices("etaoin漢", k=60)) for _ in range(5000)) for _ in range(14)]
    for i, t in enumerate(texts):
        got = enc.encode_many([t], [i])
        most = max(most, sum(map(sys.getsizeof, enc.root)) + sys.getsizeof(enc.root) + 32 * len(enc.root)
                   + 16 * enc.nodes + 4 * enc.stored)
    assert most < 60_000_000
    assert got == sentencepiece_bpe.Encoder(vocab, 0.1, 7).encode_many([texts[-1]], [len(texts) - 1])
