"""Personal data: base spans against plain patterns, the field against enumeration, and what it adds."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from medalyst.llm import pii_crf

PATTERNS = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub(r"[^0-9]", "", m.group())
            fine = [True, kind != 1 or all(int(p) <= 255 for p in m.group().split(".")), 14 <= len(digits) <= 19 and pii_crf.luhn(digits),
                    10 <= len(digits) <= 15][kind]
            if fine:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_of_random_texts():
    rng = random.Random(3)
    parts = ["a", "b.", "@", "-", "+1", "23", "4", " ", "(", ")", ".", "_%", "255.", "4539578763621486", "é", "+1 (743) 555-3824", "x@y.org", "1.2.3.4"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii_crf.base_spans(text) == brute(text), repr(text)
    long = "7" * 20_000 + "@" * 5000 + "a" * 20_000 + "+1" + " " * 20_000
    assert pii_crf.base_spans(long) == []


def test_dynamic_program_finds_the_best_choice():
    rng = np.random.default_rng(2)
    k = len(pii_crf.KINDS)
    for text in ("call 743-555-3824 a", "1234567 b@c 12", "x 12345678"):
        field = pii_crf.Field(rng.normal(size=(k, pii_crf.N_FEATURES)), rng.normal(size=(k + 1, k + 1)))
        n, candidates, tokens = field.segments(text)

        def ways(at, n=n, candidates=candidates):
            if at == n:
                yield []
                return
            for rest in ways(at + 1):
                yield [(at, at + 1, k, None), *rest]
            for (i, j, phi), y in itertools.product(candidates, range(k)):
                if i == at:
                    for rest in ways(j):
                        yield [(i, j, y, phi), *rest]

        def value(way, field=field):
            labels = [k, *[y for *_, y, _ in way]]
            return sum(field.moves[a, b] for a, b in itertools.pairwise(labels)) + sum(field.weights[y] @ phi for *_, y, phi in way if y < k)

        best = max(ways(0), key=value)
        assert field.best(text) == [(tokens[i][0], y, tokens[j - 1][1]) for i, j, y, _ in best if y < k]


@pytest.fixture(scope="module")
def docs_and_rows(make_docs):
    rng = random.Random(5)
    rows = []
    for i in range(40):
        phone = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        rows.append((i, f"some words here {rng.choice([phone, f'joe.{i}@mail.example.com', f'{i}.20.30.40', '4539578763621486'])} and then more. 3.", "en", "a"))
    rows += [(100, "call (743) 555-3824 now", "en", "a"), (101, "write bob.smith [at] example.com please", "en", "a"), (102, "on 2024-01-15 we paid 1,234,567.89 for 2.0.1", "en", "a"),
             (103, "nothing", "en", "a"), (104, "see +1 (743) 555-3824 there", "en", "a")]
    return make_docs(rows), rows


def test_added_spans(docs_and_rows):
    docs, rows = docs_and_rows
    found = {r["doc_id"]: r for r in pii_crf.report(docs, pii_crf.learn(docs)).collect()}
    for i, text, *_ in rows:
        base = [f"{pii_crf.KINDS[k]}:{s}:{e}" for s, k, e in brute(text)]
        assert found[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(found[i]["spans"].split(","))
    assert found[100]["spans"] == "phone:5:19" and found[101]["spans"] == "email:6:32"
    assert found[102]["spans"] == found[103]["spans"] == "" and found[104]["spans"] == "phone:4:21"


def test_odd_rows(odd_docs, odd_rows, no_docs):
    assert pii_crf.learn(no_docs) is None and pii_crf.learn(odd_docs) is None
    rows = pii_crf.report(odd_docs, None).collect()
    assert len(rows) == len(odd_rows) and all(r["spans"] == "" and r["n_email"] == 0 for r in rows)
    assert pii_crf.report(no_docs, None).collect() == []
