"""Secrets: base patterns against plain regular expressions, and the guess-cost programme."""

import itertools
import math
import random
import re

import pytest

from tidemark.llm import secrets_guess as s
from tidemark.llm import spans

PIECES = ["token", "TOKEN", "PassWord", "=", ":", " ", '"', "abc", "AKIA", "ABCDEFGH1234", "0123456789ab", "z", "apikey", "api_key", "é", "ſecret", ".", "\n"]
_CASES = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = re.compile(rf"""({_CASES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    return found + [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    for _ in range(30_000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 14)))
        assert sorted(s.base_spans(text)) == sorted(plain(text)), text


def test_query_on_the_test_table(tables, corpus):
    got = {r.doc_id: r for r in s.detect(tables("documents")).collect()}
    for doc, text in corpus:
        base = plain(text)
        assert got[doc].base_sha256 == spans.sha256(spans.joined(base, s.KINDS))
        assert (got[doc].n_assign, got[doc].n_access, got[doc].n_hex) == tuple(sum(k == x for k, _, _ in base) for x in s.KINDS)


def brute_force_cost(value):
    """Least cost over every way to cut a short value, part by part."""
    lower = value.lower()

    def part(a, b):
        text, small = value[a:b], lower[a:b]
        costs = [sum(map(s._one, text))]
        for form, extra in ((small, 0.0), (small.translate(s._LEET), 0.7)):
            if form in s._WORDS and b - a >= 3:
                costs.append(math.log10(s._WORDS[form] + 1) + extra + (0.3 if text != small else 0.0))
                break
        if b - a >= 3 and len(set(small)) == 1 and (a == 0 or lower[a - 1] != small[0]) and (b == len(lower) or lower[b] != small[0]):
            costs.append(s._one(value[a]) + math.log10(b - a))
        walk = lambda i: i + 1 < len(lower) and (lower[i], lower[i + 1]) in s._NEXT
        if b - a >= 3 and all(walk(i) for i in range(a, b - 1)) and not walk(b - 1) and not (a and walk(a - 1)):
            costs.append(math.log10(47) + math.log10(2 * (b - a)))
        m = s._DATE.match(value, a)
        if m and len(m[1]) == b - a:
            costs.append(math.log10(120 * (1 if b - a == 4 else 366)))
        return min(costs) + s.PART

    n = len(value)
    return min(
        sum(part(a, b) for a, b in zip((0, *cut), (*cut, n)))
        for k in range(n)
        for cut in itertools.combinations(range(1, n), k)
    )


@pytest.mark.parametrize("value", ["abc123", "pass2024", "qwe7aaa", "P@ss1999", "zzzx", "dragonab", "x9Kq2", "20240131", "tokentest"])
def test_cost_is_the_minimum_over_all_cuts(value):
    assert s.guess_cost(value) == pytest.approx(brute_force_cost(value))


def test_order_of_costs():
    weak = ["password", "changeme", "qwertyuiop", "aaaaaaaa", "P@ssw0rd1", "summer2024", "12345678"]
    strong = ["x9Kq2LmZ81pQ", "b3f1a9c77d", "Tr0ub4dor&3"]
    assert max(map(s.guess_cost, weak)) < s.COST < min(map(s.guess_cost, strong))
    assert s.guess_cost("") == 0


def test_hard_values_in_context_are_added():
    text = "my pwd is x9Kq2LmZ81pQ. login: admin123 and db://bob:s8Fk2mQz9@host"
    base, more = s.find(text)
    assert base == [] and [text[a:b] for _, a, b in more] == ["pwd is x9Kq2LmZ81pQ", "://bob:s8Fk2mQz9"]


@pytest.mark.parametrize("unit", ["token", "token=", "token ", "f", "AKIA", "://a:", "pwd is ", "key" + " " * 50])
def test_long_uniform_texts_take_linear_time(unit):
    s.find(unit * (100_000 // len(unit)))


def test_awkward_rows(awkward, none):
    rows = s.detect(awkward).collect()
    assert len(rows) == awkward.count() and all(r.spans == "" for r in rows)
    assert s.redact(awkward).columns == awkward.columns
    assert s.detect(none).collect() == []


@pytest.mark.parametrize("user", ["", "u", "u" * 200])
@pytest.mark.parametrize("n", [1, 11, 400])
def test_passwords_in_addresses_of_any_length(user, n):
    value = "x9Kq2LmZ81pQ" * n
    text = f"see amqp://{user}:{value}@host/x"
    base, more = s.find(text)
    assert base == [] and [text[a:b] for _, a, b in more] == [f"://{user}:{value}"]


@pytest.mark.parametrize("unit", ["://", "://a:b", "://:", ":", "a:", "://a:b@"])
def test_long_uniform_addresses_take_linear_time(unit):
    s.added_spans(unit * (100_000 // len(unit)), [])
