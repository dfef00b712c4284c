"""Personal data by fixed patterns, widened by a semi-Markov conditional random field.

The patterns give base spans that always stay. Around digits, ``@`` and spelled-out ``[at]`` the field scores every candidate segment of up to
``MOST_TOKENS`` tokens as a whole (its shape, digit count, check digit, neighbours) for each type, and a dynamic program over bounded segments
chooses boundaries and types together. Its spans that touch no base span are added: numbers without their ``+``, spelled-out addresses, cards with
other separators.

The field is fitted here, by its likelihood, on segments of at most ``sample`` documents (the documented bound of the fit): base spans are the
labels, with rewritten forms of them and of plain numbers beside them. Without a base span in the sample nothing is added.

Defined cases: NULL text counts as empty and has no spans; positions are code points, end exclusive; repeated rows give repeated results; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalyst.llm.arrow import with_outputs

KINDS = ("email", "ip", "card", "phone")
MOST_TOKENS, MOST_CHARS = 16, 80
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[\[({]at[\])}]")
_CHUNK = re.compile(r"\S+")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|\s+|.", re.DOTALL)
Span = tuple[int, int, int]      # start, kind, end


def luhn(digits: str) -> bool:
    """Whether the check digit of ``digits`` is right."""
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by start, then kind."""
    out: list[Span] = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            out.append((start, 0, found.end()))
            last = found.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(at + 1, last))
    for found in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in found.group().split(".")):
            out.append((found.start(), 1, found.end()))
    for found in _CARD.finditer(text):
        digits = _digits(found.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((found.start(), 2, found.end()))
    for found in _PHONE.finditer(text):
        if 10 <= len(_digits(found.group())) <= 15:
            out.append((found.start(), 3, found.end()))
    return sorted(out)


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Runs of chunks with a digit, an ``@`` or a spelled-out at-sign, with one chunk before and after."""
    if not _TRIGGER.search(text):
        return
    chunks = [(m.start(), m.end()) for m in _CHUNK.finditer(text)]
    marked = [i for i, (a, b) in enumerate(chunks) if _TRIGGER.search(text, a, b)]
    i = 0
    while i < len(marked):
        j = i
        while j + 1 < len(marked) and marked[j + 1] <= marked[j] + 2:
            j += 1
        yield chunks[max(0, marked[i] - 1)][0], chunks[min(len(chunks) - 1, marked[j] + 1)][1]
        i = j + 1


_SHAPES = [re.compile(p) for p in (
    r"\d{1,3}(?:\.\d{1,3}){3}",                                                            # four short numbers
    r"[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",                                        # an address
    r"[\w.%+-]+ ?[\[({]at[\])}] ?[A-Za-z0-9-]+(?:(?:\.| ?[\[({]dot[\])}] ?)[A-Za-z0-9-]+)+",   # one spelled out
    r"(?:\d{1,3}[ .-])?\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}",                                  # a national number
    r"\+?\d[\d ().-]{6,}\d",                                                               # any number with separators
    r"\d{4}(?:[ .-]\d{4}){3}",                                                             # four fours
    r"\d{4}-\d\d-\d\d|\d{1,2}[./]\d{1,2}[./]\d{2,4}",                                      # a date
    r"\d+(?:[.,:/]\d+)+",                                                                  # a version, amount or time
    r"\d+",                                                                                # one run of digits
)]
N_FEATURES = 12 + len(_SHAPES) + 4


def features(text: str, start: int, end: int) -> np.ndarray:
    """What a segment looks like as a whole and beside its neighbours."""
    part = text[start:end]
    digits = _digits(part)
    n = len(digits)
    before, after = text[start - 1:start], text[end:end + 1]
    return np.array([
        1, part[0] == "+", n < 7, 7 <= n <= 9, 10 <= n <= 12, n == 13, 14 <= n <= 19, n > 19, 14 <= n <= 19 and luhn(digits),
        any(c.isalpha() for c in part), " " in part, "(" in part,
        *[bool(shape.fullmatch(part)) for shape in _SHAPES],
        before.isalnum() or before == "@", after.isalnum() or after == "@", before in ("+", ".", "-", "/", ":"), not (part[-1].isalnum()),
    ], dtype=np.float64)


@dataclass
class Field:
    """Weights of (kind, feature) and of (kind or none before, kind or none after)."""

    weights: np.ndarray
    moves: np.ndarray

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, np.ndarray]], list[tuple[int, int]]]:
        """Number of tokens, candidate segments (first token, token after, features), and token positions."""
        tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
        weight = np.cumsum([0, *[sum("0" <= c <= "9" for c in text[a:b]) + 7 * (text[a:b] in ("@", "at")) for a, b in tokens]])
        out = []
        for i, (start, _) in enumerate(tokens):
            if text[start].isspace():
                continue
            for j in range(i + 1, min(i + MOST_TOKENS, len(tokens)) + 1):
                end = tokens[j - 1][1]
                if end - start > MOST_CHARS:
                    break
                if weight[j] - weight[i] >= 7 and not text[end - 1].isspace():
                    out.append((i, j, features(text, start, end)))
        return len(tokens), out, tokens

    def best(self, text: str) -> list[Span]:
        """The best joint choice of segments and kinds."""
        n, candidates, tokens = self.segments(text)
        if not candidates:
            return []
        k = len(KINDS)
        value = np.full((n + 1, k + 1), -np.inf)
        value[0, k] = 0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        by_end: dict[int, list[tuple[int, np.ndarray]]] = {}
        for i, j, phi in candidates:
            by_end.setdefault(j, []).append((i, self.weights @ phi))
        for j in range(1, n + 1):
            from_none = value[j - 1] + self.moves[:, k]
            value[j, k] = from_none.max()
            back[j, k] = (j - 1, int(from_none.argmax()))
            for i, scores in by_end.get(j, ()):
                came = value[i][:, None] + self.moves[:, :k]
                total = came.max(axis=0) + scores
                for y in np.flatnonzero(total > value[j, :k]).tolist():
                    value[j, y] = total[y]
                    back[j, y] = (i, int(came[:, y].argmax()))
        out, j, y = [], n, int(value[n].argmax())
        while j:
            i, previous = back[j, y]
            if y < k:
                out.append((tokens[i][0], y, tokens[j - 1][1]))
            j, y = i, previous
        return out[::-1]


def _likelihood(field: Field, n: int, candidates: list, gold: set[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of one text's log likelihood: what its labels hold less what the field expects (forward and backward sums)."""
    k = len(KINDS)
    scores = [field.weights @ phi for _, _, phi in candidates]
    starts: dict[int, list[int]] = {}
    ends: dict[int, list[int]] = {}
    for c, (i, j, _) in enumerate(candidates):
        starts.setdefault(i, []).append(c)
        ends.setdefault(j, []).append(c)
    ahead, behind = np.full((n + 1, k + 1), -np.inf), np.full((n + 1, k + 1), -np.inf)
    ahead[0, k] = 0
    behind[n] = 0
    add = np.logaddexp
    for j in range(1, n + 1):
        ahead[j, k] = add.reduce(ahead[j - 1] + field.moves[:, k])
        for c in ends.get(j, ()):
            ahead[j, :k] = add(ahead[j, :k], add.reduce(ahead[candidates[c][0]][:, None] + field.moves[:, :k], axis=0) + scores[c])
    for i in range(n - 1, -1, -1):
        total = field.moves[:, k] + behind[i + 1, k]
        for c in starts.get(i, ()):
            total = add(total, add.reduce(field.moves[:, :k] + scores[c] + behind[candidates[c][1], :k], axis=1))
        behind[i] = total
    whole = behind[0, k]
    grad, moves = np.zeros_like(field.weights), np.zeros_like(field.moves)
    for i in range(n):
        moves[:, k] -= np.exp(ahead[i] + field.moves[:, k] + behind[i + 1, k] - whole)
    for c, (i, j, phi) in enumerate(candidates):
        share = np.exp(ahead[i][:, None] + field.moves[:, :k] + scores[c] + behind[j, :k] - whole)
        moves[:, :k] -= share
        grad -= np.outer(share.sum(axis=0), phi)
    at, last = 0, k
    by_start = {i: (j, y) for i, j, y in gold}
    phis = {(i, j): phi for i, j, phi in candidates}
    while at < n:
        j, y = by_start.get(at, (at + 1, k))
        moves[last, y] += 1
        if y < k:
            grad[y] += phis[at, j]
        at, last = j, y
    return grad, moves


def fit(labelled: list[tuple[str, list[Span]]], rounds: int = 30, rate: float = 0.3, decay: float = 0.02) -> Field:
    """Maximise the likelihood of the labelled texts by scaled gradient steps; texts whose labels are no candidates are left out."""
    k = len(KINDS)
    field = Field(np.zeros((k, N_FEATURES)), np.zeros((k + 1, k + 1)))
    field.weights[:, 0] = -2.0
    data = []
    for text, spans in labelled:
        n, candidates, tokens = field.segments(text)
        first, after = {a: i for i, (a, _) in enumerate(tokens)}, {b: i + 1 for i, (_, b) in enumerate(tokens)}
        gold = {(first.get(s, -1), after.get(e, -1), y) for s, y, e in spans}
        known = {(i, j) for i, j, _ in candidates}
        if n <= 40 and all((i, j) in known for i, j, _ in gold):
            data.append((n, candidates, gold))
    square = [np.full_like(field.weights, 1e-3), np.full_like(field.moves, 1e-3)]
    for _ in range(rounds if data else 0):
        total = [-decay * field.weights, -decay * field.moves]
        for n, candidates, gold in data:
            for t, g in zip(total, _likelihood(field, n, candidates, gold), strict=True):
                t += g
        for value, grad, s in zip((field.weights, field.moves), total, square, strict=True):
            s += grad * grad
            value += 2 * rate * grad / np.sqrt(s)
    return field


def rewritten(kind: int, text: str) -> list[tuple[str, int | None]]:
    """Other forms of a base span with the kind that they have, and lookalikes with none."""
    digits = _digits(text)
    if kind == 3 and len(digits) == 11:
        a, b, c, d = digits[0], digits[1:4], digits[4:7], digits[7:]
        return [(f"({b}) {c}-{d}", 3), (f"{b}-{c}-{d}", 3), (f"{a}-{b}-{c}-{d}", 3), (f"{b}.{c}.{d}", 3), (f"{b} {c} {d}", 3),
                (digits[:9], None), (f"20{b[:2]}-{1 + int(c) % 9:02d}-{10 + int(d) % 18}", None), (f"{b},{c},{d[:3]}", None), (f"{b}-{c}", None),
                (f"978-{a}-{b[:2]}-{c}{d[:3]}-{d[3]}", None)]
    if kind == 0 and "@" in text:
        user, host = text.split("@", 1)
        return [(f"{user} [at] {host}", 0), (f"{user}(at){host}", 0), (f"{user} [at] {host.replace('.', ' [dot] ')}", 0), (f"{user} {host}", None)]
    if kind == 2 and len(digits) == 16:
        fours = [digits[i:i + 4] for i in range(0, 16, 4)]
        wrong = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        return [(".".join(fours), 2), (wrong, None), (".".join([*fours[:3], wrong[-4:]]), None)]
    if kind == 1:
        parts = text.split(".")
        return [(".".join(parts[:3]), None), (".".join([*parts, "7"]), None), (".".join([str(int(p) + 300) for p in parts]), None)]
    return []


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = 200) -> Field | None:
    """Fit the field on at most ``sample`` documents that have a trigger, taken by the hash of their ids and texts."""
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("body"), F.col(doc_id).cast("string").alias("id"))
    picked = (rows.where(F.col("body").rlike(r"@[A-Za-z0-9]|\+[0-9]|[0-9]\.[0-9]|[0-9]{14}")).select(F.xxhash64("id", "body").alias("key"))
              .distinct().orderBy("key").limit(sample))
    # at most `sample` distinct texts
    bodies = (rows.withColumn("key", F.xxhash64("id", "body")).join(F.broadcast(picked), "key").select("key", "body").dropDuplicates(["key"])
              .orderBy("key").collect())
    labelled: dict[str, list[Span]] = {}
    seen: dict[str, int] = {}
    for row in bodies:
        body, found = row["body"], base_spans(row["body"])
        for start, end in islands(body):
            part = body[start:end]
            inside = [(s - start, y, e - start) for s, y, e in found if s >= start and e <= end]
            apart = all(x[2] <= y[0] for x, y in zip(inside, inside[1:], strict=False))
            shape = re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", lambda m: "9" * min(5, len(m.group())), part))
            if len(part) <= 120 and apart and seen.get(shape, 0) < 2:
                seen[shape] = seen.get(shape, 0) + 1
                labelled.setdefault(part, inside)
                for s, y, e in inside:
                    for form, kind in rewritten(y, part[s:e]):
                        form_text = f"{part[:s]}{form}{part[e:]}"
                        if kind is None or not base_spans(form_text):
                            labelled.setdefault(form_text, [(s, kind, s + len(form))] if kind is not None and len(inside) == 1
                                                else base_spans(form_text) if kind is None else [])
    useful = [(part, spans) for part, spans in labelled.items() if all(x[2] <= y[0] for x, y in zip(spans, spans[1:], strict=False))]
    return fit(useful) if any(spans for _, spans in useful) else None


def all_spans(text: str, field: Field | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and the field's spans that touch none of them."""
    base = base_spans(text)
    if field is None:
        return base, []
    added = []
    for start, end in islands(text):
        held = [(s, e) for s, _, e in base if s < end and e > start]
        for s, kind, e in field.best(text[start:end]):
            if not any(a < e + start and s + start < b for a, b in held):
                added.append((s + start, kind, e + start))
    return base, added


def find(docs: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``added``: arrays of (start, kind, end) with the number of the kind."""

    def compute(texts: list[str | None]) -> list[list]:
        found = [all_spans(t or "", field) for t in texts]
        name = lambda spans: [{"start": s, "kind": k, "end": e} for s, k, e in spans]
        return [[name(base) for base, _ in found], [name(added) for _, added in found]]

    span = "array<struct<start:int,kind:int,end:int>>"
    return with_outputs(docs, text, f"base {span}, added {span}", compute)


def report(docs: DataFrame, field: Field | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts by kind, the hash of the base spans, and all spans as text."""
    found = find(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), field)
    names = F.array(*[F.lit(kind) for kind in KINDS])
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda i: F.size(F.filter("base", lambda x: x["kind"] == i)).cast("bigint")
    return found.select("doc_id", *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
                        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                        listed(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("bigint").alias("n_added"))
