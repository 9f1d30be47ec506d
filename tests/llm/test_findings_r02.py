
import math
import random

import numpy as np
import pytest
import xxhash

from carelake.llm import html_extract, license_scan, near_dedup, pii_boost, sentencepiece_bpe
from carelake.llm.common import materialize


@pytest.fixture(scope="module")
def vocab():
    return sentencepiece_bpe.Vocabulary.load()


def test_dropout_varies_between_documents_and_occurrences(spark, vocab):
    docs = spark.createDataFrame([(i, f"document {i} " + "international " * 40) for i in range(60)], "doc_id bigint, text string")
    cuts = {}
    word = "▁international"
    for r in sentencepiece_bpe.encode(docs, vocab).collect():
        assert r["lossless"]
        at, found = "", []
        for i in r["ids"]:
            p = vocab.pieces[i]
            if p.startswith("▁") and at:
                found.append(at)
                at = ""
            at += ("|" if at else "") + p
        cuts[r["doc_id"]] = [x for x in [*found, at] if x.replace("|", "") == word]
    assert all(len(x) == 40 for x in cuts.values())
    assert all(len(set(x)) > 2 for x in cuts.values())  # within a document
    assert len({tuple(x) for x in cuts.values()}) == 60  # between documents
    assert len({x for c in cuts.values() for x in c}) > 20


def test_dropout_is_that_of_the_plain_agenda(vocab):
    r = random.Random(4)
    words = ["the", "international", "▁", "x" * 70, "naïve", "漢字", "tokenization", "\n", "😀", "a▁b"]
    for rate in (0.0, 0.1, 0.5):
        enc = sentencepiece_bpe.Encoder(vocab, rate, 3)
        texts = [" ".join(r.choice(words) for _ in range(r.randrange(60))) for _ in range(80)]
        keys = [xxhash.xxh64_intdigest(t) for t in texts]
        for t, k, got in zip(texts, keys, enc.encode_many(texts, keys), strict=True):
            want, at = b"", 0
            for c in enc._split(t):
                want += enc.merge_long(c, k, at) if c else enc.escaped
                at += max(1, len(c))
            assert got == want
            assert enc.decode(np.frombuffer(got, np.int32).tolist()) == t


@pytest.mark.parametrize("text, labels", [
    ("released under MIT, parts licensed under Apache-2.0", "apache-2.0,mit"),
    ("SPDX-License-Identifier: MIT and released under ISC; SPDX-License-Identifier: Foo-1.0", "foo-1.0,isc,mit"),
    ("Licensed under\n  Apache-2.0 or\n  MIT", "apache-2.0,mit"),
    ("// SPDX-License-Identifier:\n// MIT\n// and other words", "mit"),
    ("SPDX-License-Identifier: MIT\nwith code", "mit")])
def test_all_triggers_of_a_text_are_read(text, labels):
    assert license_scan.scan_text(text.encode(), license_scan.build_automaton())[5] == labels


@pytest.mark.parametrize("s", [near_dedup.QUERY, near_dedup.STAGE])
def test_pairs_at_the_threshold_are_verified(s):
    p, m = 1 - s.percent / 100, s.registers
    n = np.array([1000])
    lost = 0.0
    for k in range(m + 1):  # differing registers of sets of one size
        regs = np.zeros((1, m), np.uint16)
        regs[0, :k] = np.arange(k) % 2 * 2 + 1
        if not near_dedup._likely(regs, np.ones((1, m), np.uint16) * (regs > 0) * 2, n, n, s)[0]:
            lost += math.comb(m, k) * p ** k * (1 - p) ** (m - k)
    assert lost <= s.miss() - (1 - (1 - p) ** s.rows) ** s.bands + 1e-12 and s.miss() < 2e-5


def test_number_spans_come_out(spark):
    r = random.Random(6)
    digits = lambda n: "".join(r.choice("123456789") for _ in range(n))
    rows = [(i, f"her account {digits(10)} was closed") for i in range(100)]
    rows += [(100 + i, f"filed as 2{digits(2)}-{digits(2)}-{digits(4)} there") for i in range(100)]
    rows += [(200 + i, f"reach me 4{digits(2)}-3{digits(2)}-{digits(4)} today") for i in range(100)]
    rows += [(300 + i, f"hotel part {digits(10)} in stock, {digits(3)}-{digits(7)} sold") for i in range(200)]
    rows += [(500 + i, "paid by 4111111111111111 from 10.20.30.40 then") for i in range(200)]
    found = materialize(pii_boost.candidates(spark.createDataFrame(rows, "doc_id bigint, text string")), "t")
    inside = found.selectExpr("doc_id", "explode(c) x").where("doc_id >= 500 and x.g = 'digits'").select("x.y").collect()
    assert inside and all(x["y"] is None for x in inside)
    got = {x["doc_id"]: x["spans"] for x in pii_boost.find(found, pii_boost.fit(found)).collect()}
    base = lambda i: any(k in got[i] for k in ("card", "ip", "phone"))
    assert all(got[i].startswith("number:") for i in range(300) if not base(i))
    assert sum(got[i].startswith("number:") for i in range(300)) > 290
    assert not any("number" in got[i] for i in range(300, 700))


def test_unmarked_pages_keep_all_sections():
    text = [f"Section {i} has a paragraph that is long enough to be text of the page and not a label or a menu." for i in range(4)]
    section = "<section>\n<h2>\nPart {}\n</h2>\n<p>\n{}\n</p>\n</section>\n\n"
    parts = [section.format(i, t) for i, t in enumerate(text)]
    advert = "<div class='ad'>\n<p>Buy</p>\n<p>this</p>\n<p>now</p>\n<p>!</p>\n</div>\n"
    page = "<html>\n<body>\n<div>\n" + parts[0] + advert + parts[1] + advert + "<p>Short.</p>\n" + advert + "".join(parts[2:]) + "</div>\n"
    want = ["Part 0", text[0], "Part 1", text[1], "Short.", "Part 2", text[2], "Part 3", text[3]]
    assert html_extract.extract_text(page).split("\n") == want


def test_a_marked_teaser_does_not_replace_the_body():
    body = [f"Paragraph {i} of the real text, which stands in a plain division and is longer than any card." for i in range(5)]
    page = "<div>" + "".join(f"<p>{t}</p>" for t in body) + "</div>" + "<article><p>Teaser</p></article>"
    got = html_extract.extract_text(page).split("\n")
    assert got[:5] == body
    page = "<article>" + "".join(f"<p>{t}</p>" for t in body) + "</article><div>" + "<p>" + "a blurb " * 12 + "</p></div>"
    assert html_extract.extract_text(page).split("\n") == body
