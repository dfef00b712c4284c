"""Secret spans against plain regular expressions, and ownership against a dictionary."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from medalyst.llm import secrets

PATTERNS = {
    "assign": (re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}
NONE = hashlib.sha256(b"").hexdigest()


def brute(text):
    out = []
    for kind, (name, (pattern, group, least)) in enumerate(PATTERNS.items()):
        out += [(m.start(), kind, m.end(), name) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return [f"{name}:{start}:{end}" for start, _, end, name in sorted(out)]


def digest(docs, **more):
    return {r["doc_id"]: r for r in secrets.report(secrets.judged(docs, owner=F.col("source"), repository=F.col("lang"), **more)).collect()}


def test_base_spans(make_docs):
    rng = random.Random(8)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", "=", ": ", '"', "'", " ", "AKIA", "ABCDEF0123456789", "0123456789abcdef", "f00", "é", "🎉", "x_y.z-",
             "\n", "passwd", "abc", "/+"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14))), "en", "a") for i in range(600)]
    rows += [(1000, "token: secret: abcdefghijklmnop", "en", "a"), (1001, "AKIAAKIA" + "A" * 14, "en", "a"), (1002, "x" * 50_000 + " deadbeefdeadbeef", "en", "a")]
    found = digest(make_docs(rows))
    for i, text, *_ in rows:
        spans = brute(text)
        assert found[i]["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), repr(text)
        assert [found[i][f"n_{k}"] for k in PATTERNS] == [sum(s.startswith(k) for s in spans) for k in PATTERNS]
        assert set(spans) <= set(found[i]["spans"].split(","))


def test_copied_and_owned_values(make_docs):
    copied, owned, provider = "token = copiedExample0123", "token = ownedValue98765432", "key ghp_abcdefghijklmnopqrst0123"
    rows = [(i, copied, "en", f"owner{i}") for i in range(4)] + [(10, owned, "en", "x"), (11, owned, "fr", "x"), (12, provider, "en", "y")]
    found = digest(make_docs(rows))
    assert [found[i]["n_copied"] for i in (0, 3, 10, 11)] == [1, 1, 0, 0] and [found[i]["n_live"] for i in (0, 10, 12)] == [0, 1, 1]
    assert found[12]["spans"].startswith("provider:4:") and found[12]["base_sha256"] == NONE
    everywhere = digest(make_docs([(i, provider, "en", f"o{i}") for i in range(5)]))
    assert all(r["spans"] == "" for r in everywhere.values())


def test_counts_of_places(make_docs):
    rows = [(1, "token=aaaaaaaaaaaaZ", "en", "a"), (2, "token=aaaaaaaaaaaaZ", "fr", "a"), (3, "token=aaaaaaaaaaaaZ", "fr", "b"), (3, "token=aaaaaaaaaaaaZ", "fr", "b"),
            (4, "token=aaaaaaaaaaaaZ", None, None)]
    row = secrets.ownership(secrets.scan(make_docs(rows), owner=F.col("source"), repository=F.col("lang"))).collect()
    assert [(r["owners"], r["repositories"]) for r in row] == [(3, 4)]


def test_odd_rows_and_empty_table(odd_docs, odd_rows, no_docs):
    rows = secrets.report(secrets.judged(odd_docs, owner=F.col("source"), repository=F.col("lang"))).collect()
    assert len(rows) == len(odd_rows) and all(r["n_assign"] == 0 for r in rows)
    assert secrets.judged(no_docs).collect() == [] and secrets.redact(no_docs).columns == no_docs.columns


def test_redaction(make_docs):
    rows = [(1, 'é token = "abcdefabcdef0123456789" end', "en", "a"), (2, "nothing here", "en", "a"), (3, None, "en", "a"), (4, "token=copied0123456789", "en", "a"),
            (5, "token=copied0123456789", "en", "b"), (6, "token=copied0123456789", "en", "c"), (1, 'é token = "abcdefabcdef0123456789" end', "en", "a")]
    docs = make_docs(rows)
    done = secrets.redact(docs, owner=F.col("source"))
    assert done.columns == docs.columns
    found = sorted((r["doc_id"], r["text"]) for r in done.collect() if r["text"] is not None)
    assert found == [(1, 'é token = "[SECRET]" end')] * 2 + [(2, "nothing here")] + [(i, "token=copied0123456789") for i in (4, 5, 6)]
    assert done.count() == len(rows)


def test_plan_has_no_python(make_docs, capsys):
    secrets.report(secrets.judged(make_docs([(1, "a", "en", "a")]))).explain()
    assert "Python" not in (plan := capsys.readouterr().out) and "Arrow" not in plan and "Pandas" not in plan
