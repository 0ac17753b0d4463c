"""Personal data: base patterns against plain regular expressions, and the aggregation of labelers."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest

from tidemark.llm import pii_weak as p
from tidemark.llm import spans

PIECES = ["@", "a", "b.", ".", "1", "25", "256", "-", " ", "+", "(", "9", "é", "%", "4111 1111 1111 1111", "1.2.3.4", "@a.b", "+1 (555) 010-9999"]


def plain(text):
    found = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and p.luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for _ in range(30_000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 14)))
        assert sorted(p.base_spans(text)) == sorted(plain(text)), text


@pytest.mark.parametrize("unit", ["1", "1.", "a@", "a", "+1", "1 ", "@", "12-"])
def test_long_uniform_texts_take_linear_time(unit):
    p.judged(unit * (400_000 // len(unit)))


def test_query_on_the_test_table(tables, corpus):
    got = {r.doc_id: r for r in p.detect(tables("documents")).collect()}
    some = 0
    for doc, text in corpus:
        base = plain(text)
        row = got[doc]
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(k == x for k, _, _ in base) for x in p.KINDS)
        assert row.base_sha256 == hashlib.sha256(spans.joined(base, p.KINDS).encode()).hexdigest()
        assert set(spans.joined(base, p.KINDS).split(",")) <= set(row.spans.split(","))
        some += bool(base)
    assert some


def test_em_learns_which_labelers_to_trust():
    rng = random.Random(2)
    right = (0.95, 0.9, 0.85, 0.6, 0.3)  # the last one is mostly wrong
    counts = Counter()
    for _ in range(4000):
        truth = 1 if rng.random() < 0.4 else -1
        counts["phone", tuple(truth if rng.random() < r else -truth for r in right)] += 1
    m = p.estimate(counts)
    trusted = [(m.reliability[1, k, 2] + m.reliability[0, k, 0]) / 2 for k in range(5)]
    assert all(abs(a - b) < 0.06 for a, b in zip(trusted, right))
    assert abs(m.prior - 0.4) < 0.05
    assert m.probability("phone", (1, 1, 1, 1, -1)) > 0.9 > 0.1 > m.probability("phone", (-1, -1, -1, -1, 1))


def test_accepted_candidates_are_added_and_base_spans_stay(spark):
    texts = ["call +1 (555) 010-9999 now", "phone (555) 010-9999 please", "mail bob at example dot com", "isbn 1234567890123"] * 5
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r.spans for r in p.detect(frame).collect()}
    assert rows[0] == "phone:5:22" and rows[1] == "phone:6:20" and rows[3] == ""


def test_redaction_changes_text_and_length_only(spark, awkward, none):
    frame = spark.createDataFrame([(1, "to a@b.cd or 1.2.3.4!", "en", "s", 21, 0.1, "c", 3), (2, None, None, None, None, None, None, None)], awkward.schema)
    rows = p.redact(frame).orderBy("doc_id").collect()
    assert rows[0].text == "to <EMAIL> or <IP>!" and rows[0].n_chars == len(rows[0].text) and rows[0].score == 0.1
    assert rows[1].text is None and rows[1].n_chars is None
    assert p.redact(awkward).columns == awkward.columns and p.redact(awkward).count() == awkward.count()
    assert p.redact(none).count() == 0


def test_awkward_rows(awkward, none):
    rows = p.detect(awkward).collect()
    assert len(rows) == awkward.count() and all(r.spans == "" for r in rows)
    assert {r.base_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert p.detect(none).collect() == []


def test_parts_of_any_length():
    """A part with more digits than int() takes is no error; leading zeros count for nothing."""
    text = f"a 1.2.3.{'0' * 5000}1 b 1.2.3.{'9' * 5000} c"
    assert p.base_spans(text)[0] == ("ip", 2, 2 + 6 + 5001)
    assert sum(k == "ip" for k, _, _ in p.base_spans(text)) == 1


def test_taken_equals_a_scan():
    rng = random.Random(5)
    for _ in range(300):
        several = [("ip", a, a + rng.randint(1, 9)) for a in (rng.randint(0, 60) for _ in range(rng.randint(0, 8)))]
        taken, free = spans.Taken(several), []
        for _ in range(20):
            a = rng.randint(0, 70)
            span = ("card", a, a + rng.randint(1, 6))
            meets = any(span[1] < e and s < span[2] for _, s, e in several + free)
            assert taken.meets(span) == meets
            if not meets:
                free.append(span)
                taken.add(span)


def test_many_matches_in_a_long_text_take_linear_time():
    """Twenty thousand spans and as many candidates that they cover."""
    find = p.finder(p.Model(p.np.full((2, 5, 3), 0.5), 0.5, p.np.full(15, 1.0)))
    text = "10.0.0.1 a@b.co 4111 1111 1111 1111 9807915762804490 " * 10_000
    start = time.monotonic()
    base, more = find(text)
    assert len(base) >= 20_000 and time.monotonic() - start < 20
