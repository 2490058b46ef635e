"""Personal data by a skip-chain conditional random field over the numeric tokens of a document.

Four patterns give the base spans, which always stay. A field then labels every
token with a digit or an at sign as one of the four kinds or as other. Its
potentials are
- the shape of the token (digits, letters and marks, without the plus sign that
  the phone pattern hangs on),
- chain links between tokens with nothing but blanks between them,
- skip links between a token and the next one in the document with the same key:
  the same digits, or the last digits of a longer number, or the same mail or IP address.
Tokens of base spans are clamped to their kind. Loopy message passing carries
that along chain and skip links, so that a number written once in full and later
without its prefix gets the same label in both places. What the field labels
beyond the base, passes the kind's own check and is sure enough is added.

Weights maximise the pseudo-likelihood of the base labels over all documents.
Documents enter as counts of (shape, neighbour labels, label), summed on the
executors; shapes are hashed, so that table is bounded whatever the input.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import for_pandas, from_pandas, small_batches, store

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
LABELS = OTHER + 1
NONE = LABELS  # a neighbour that is not there
SHAPES = 1024
SURE = 0.9
SWEEPS = 20
# digits of the key of a phone or card number; shorter numbers repeat by chance
KEY_DIGITS = 7

_DIGIT = re.compile("[0-9]")
_DIGITS = re.compile("[0-9]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# starts at the first digit of a run only: a match never begins later in it
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
_QUAD = re.compile(r"[0-9]{1,3}(?:[\[(]?\.[\])]?[0-9]{1,3}){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile("[0-9@]")
_OUTER = "\"'`.,;:!?<>[]{}=*#$%&|"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern, found from their at signs; linear in the text."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the four patterns, by kind, then start."""
    found = [(0, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _digits(m[0])
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    found.append((3, m.start(), m.end()))
    return found


def tokens(text: str) -> Iterator[tuple[int, int]]:
    """Bounds of the tokens with a digit or an at sign, without outer marks."""
    done = 0
    hit = _MARK.search(text)
    while hit:
        start, end = hit.start(), hit.end()
        while start > done and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        done = end
        while text[start] in _OUTER:
            start += 1
        while text[end - 1] in _OUTER:
            end -= 1
        yield start, end
        hit = _MARK.search(text, done)


def shape(token: str) -> int:
    """Hash of the token's form: lengths of digit runs up to 19, letters as one, marks as they are."""
    form, k = [], 0
    token = token.lstrip("+")
    while k < len(token):
        run = k
        while run < len(token) and token[run] in "0123456789":
            run += 1
        if run > k:
            form.append(str(min(run - k, 19)))
            k = run
        elif token[k].isalpha():
            while k < len(token) and token[k].isalpha():
                k += 1
            form.append("a")
        else:
            form.append(token[k])
            k += 1
    return zlib.crc32("|".join(form).encode("utf-8", "replace")) % SHAPES


def _quad(token: str) -> str:
    """The four parts of an IP address, however its dots are bracketed; empty for other tokens."""
    parts = [int(p) for p in _DIGITS.findall(token)] if _QUAD.fullmatch(token) else []
    return "{}.{}.{}.{}".format(*parts) if parts and max(parts) <= 255 else ""


def _key(token: str) -> str:
    if "@" in token:
        return token.lower()
    if quad := _quad(token):
        return quad
    digits = _digits(token)
    return digits[-KEY_DIGITS:] if len(digits) >= KEY_DIGITS else ""


def _allowed(token: str) -> int:
    """Bits of the kinds a token may have by its characters; other is always open."""
    if "@" in token:
        return 1 << 0 | 1 << OTHER
    bits = 1 << OTHER
    if _QUAD.fullmatch(token):
        bits |= 1 << 1
    if re.fullmatch(r"[0-9][0-9./-]*", token):
        bits |= 1 << 2
    if re.fullmatch(r"\+?[0-9().-]+", token):
        bits |= 1 << 3
    return bits


def graph(text: str, base: list[tuple[int, int, int]]) -> dict[str, list[int]]:
    """The nodes of a document's field: bounds, shape, kinds allowed, label, and links.

    chain is 1 if nothing but blanks lies between a node and the one before; skip
    is the number of the last node before with the same key, or -1. A base span
    spread over tokens is keyed as a whole at its last token.
    """
    out: dict[str, list[int]] = {k: [] for k in ("start", "end", "shape", "allowed", "label", "chain", "skip")}
    spans = sorted(base, key=lambda s: (s[1], s[0]))
    at, last, seen = 0, -1, {}
    for start, end in tokens(text):
        while at < len(spans) and spans[at][2] <= start:
            at += 1
        label = OTHER
        for kind, a, b in spans[at : at + 4]:
            if a < end and b > start:
                label = kind
                break
        token = text[start:end]
        chained = last >= 0 and text[last:start].isspace()
        # digits of a number written in several tokens belong to one key
        whole = token
        if chained and "@" not in token and not _quad(token):
            whole = text[out["start"][-1] : end]
        key = _key(whole) or _key(token)
        number = len(out["start"])
        for name, value in (
            ("start", start), ("end", end), ("shape", shape(token)), ("label", label),
            ("allowed", _allowed(token) | 1 << label), ("chain", int(chained)),
            ("skip", seen.get(key, -1) if key else -1),
        ):
            out[name].append(value)
        if key:
            seen[key] = number
        last = end
    return out


class Field:
    """Weights of shapes, chain links and skip links."""

    def __init__(self, node: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.node, self.chain, self.skip = node, chain, skip

    @classmethod
    def fit(cls, counts: pd.DataFrame, steps: int = 300, rate: float = 0.5, decay: float = 1e-3):
        """Pseudo-likelihood ascent over the counted cases, each weighted by how often it occurs."""
        node = np.zeros((SHAPES, LABELS))
        chain, skip = np.zeros((LABELS + 1, LABELS)), np.zeros((LABELS + 1, LABELS))
        after = np.zeros((LABELS + 1, LABELS))
        if not len(counts):
            node[:, OTHER] = 1.0
            return cls(node, chain[:LABELS], skip[:LABELS])
        s, p, n, k, y = (counts[c].to_numpy() for c in ("shape", "before", "after", "linked", "label"))
        weight = counts["n"].to_numpy(float)
        # rare shapes learn as fast as common ones: each shape's cases weigh one in all
        weight = weight / np.bincount(s, weights=weight, minlength=SHAPES)[s]
        gold = np.eye(LABELS)[y]
        for _ in range(steps):
            logit = node[s] + chain[p] + after[n] + skip[k]
            logit -= logit.max(axis=1, keepdims=True)
            prob = np.exp(logit)
            error = (gold - prob / prob.sum(axis=1, keepdims=True)) * weight[:, None]
            for table, index in ((node, s), (chain, p), (after, n), (skip, k)):
                step = np.zeros_like(table)
                np.add.at(step, index, error)
                size = np.bincount(index, weights=weight, minlength=len(table))
                table += rate * step / np.maximum(1.0, size)[:, None] - decay * table
        # one table for both directions of a chain link
        both = chain[:LABELS] + after[:LABELS].T
        same = (skip[:LABELS] + skip[:LABELS].T) / 2
        return cls(node, both, same)

    def label(self, nodes: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Most probable label of each node, and its belief, by loopy sum-product passing."""
        size = len(nodes["shape"])
        allowed = np.asarray(nodes["allowed"])[:, None] >> np.arange(LABELS) & 1
        own = np.where(allowed == 1, self.node[np.asarray(nodes["shape"])], -np.inf)
        label = np.asarray(nodes["label"])
        fixed = np.flatnonzero(label != OTHER)
        own[fixed] = -np.inf
        own[fixed, label[fixed]] = 0.0
        number = np.arange(size)
        chained = number[np.asarray(nodes["chain"]) == 1]
        skipped = number[np.asarray(nodes["skip"]) >= 0]
        left = np.concatenate((chained - 1, np.asarray(nodes["skip"])[skipped])).astype(int)
        right = np.concatenate((chained, skipped)).astype(int)
        tables = np.concatenate(
            (np.broadcast_to(self.chain, (len(chained), LABELS, LABELS)),
             np.broadcast_to(self.skip, (len(skipped), LABELS, LABELS)))
        )
        source = np.concatenate((left, right))
        target = np.concatenate((right, left))
        factor = np.concatenate((tables, tables.transpose(0, 2, 1)))
        back = np.concatenate((np.arange(len(left)) + len(left), np.arange(len(left))))
        message = np.zeros((len(source), LABELS))
        for _ in range(SWEEPS):
            total = own.copy()
            np.add.at(total, target, message)
            cavity = total[source] - message[back]
            new = _log_sum(cavity[:, :, None] + factor)
            new -= new.max(axis=1, keepdims=True, initial=-1e30)
            # halved steps keep loops from swinging
            new = 0.5 * message + 0.5 * new
            if np.abs(new - message).max(initial=0.0) < 1e-4:
                break
            message = new
        total = own.copy()
        np.add.at(total, target, message)
        belief = np.exp(total - total.max(axis=1, keepdims=True, initial=-1e30))
        belief /= belief.sum(axis=1, keepdims=True)
        best = belief.argmax(axis=1)
        return best, belief[number, best]


def _log_sum(x: np.ndarray) -> np.ndarray:
    """log of the sum of exp over the second axis."""
    top = x.max(axis=1, keepdims=True, initial=-1e30)
    return top[:, 0] + np.log(np.exp(x - top).sum(axis=1))


def cases(nodes: dict[str, list[int]]) -> Iterator[tuple[int, int, int, int, int]]:
    """(shape, label before, label after, linked label, label) of each node, NONE where there is no link."""
    label, chain, skip = nodes["label"], nodes["chain"], nodes["skip"]
    for k, y in enumerate(label):
        before = label[k - 1] if chain[k] else NONE
        after = label[k + 1] if k + 1 < len(label) and chain[k + 1] else NONE
        yield nodes["shape"][k], before, after, label[skip[k]] if skip[k] >= 0 else NONE, y


def _passes(kind: int, text: str) -> bool:
    digits = _digits(text)
    if kind == 0:
        return "@" in text.strip("@")
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def added_spans(
    nodes: dict[str, list[int]], base: list[tuple[int, int, int]], best, belief, text_of, sure: float
) -> list[tuple[int, int, int]]:
    """Spans of the field beyond the base: runs of chained nodes of one kind that pass its check."""
    out, k, size = [], 0, len(best)
    while k < size:
        kind, run = best[k], k + 1
        if kind == OTHER or nodes["label"][k] != OTHER or belief[k] < sure:
            k += 1
            continue
        while (
            run < size and nodes["chain"][run] and best[run] == kind
            and nodes["label"][run] == OTHER and belief[run] >= sure
        ):
            run += 1
        start, end = nodes["start"][k], nodes["end"][run - 1]
        if _passes(kind, text_of(k, run)) and not any(a < end and b > start for _, a, b in base):
            out.append((int(kind), start, end))
        k = run
    return out


def _nodes_of(value) -> dict[str, list[int]]:
    return {k: [int(x) for x in v] for k, v in value.items()}


NODES = "struct<" + ",".join(
    f"{k}:array<int>" for k in ("start", "end", "shape", "allowed", "label", "chain", "skip")
) + ">"


def _scan(docs: DataFrame) -> DataFrame:
    """(id, base spans, nodes, token texts) of each document, in one reading of the text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for id_, text in zip(batch["id"], batch["text"], strict=True):
                text = text or ""
                base = base_spans(text)
                nodes = graph(text, base)
                words = [text[a:b] for a, b in zip(nodes["start"], nodes["end"], strict=True)]
                flat = [x for span in base for x in span]
                out.append((id_, flat, nodes, words))
            yield pd.DataFrame(out, columns=["id", "base", "nodes", "words"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInPandas(run, f"id {kind}, base array<int>, nodes {NODES}, words array<string>")


def fit(scanned: DataFrame) -> Field:
    """Weights from the counted cases of all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for nodes in batch["nodes"]:
                total.update(cases(_nodes_of(nodes)))
        rows = [(*case, n) for case, n in total.items()]
        yield pd.DataFrame(rows, columns=["shape", "before", "after", "linked", "label", "n"])

    columns = ["shape", "before", "after", "linked", "label"]
    counted = (
        scanned.where("size(nodes.start) > 0")
        .select("nodes")
        .mapInPandas(count, "shape int, before int, after int, linked int, label int, n long")
        .groupBy(*columns)
        .agg(F.sum("n").alias("n"))
    )
    return Field.fit(counted.orderBy(*columns).toPandas())


def _order(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    return sorted(spans)


def joined(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end by kind, then start, joined by commas."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in _order(spans))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sure: float = SURE) -> DataFrame:
    """(id, base, spans): arrays of struct(kind, start, end) in code points, end exclusive.

    base has the matches of the patterns, spans also what the field adds, both by
    kind (email, ip, card, phone), then start. A null text is empty and has none.
    One row per input row; ids may repeat or be null; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts, kind = for_pandas(narrow, "id")
    scanned = store(_scan(texts))
    sent = spark.sparkContext.broadcast(fit(scanned))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base_out, all_out = [], []
            for flat, value, words in zip(batch["base"], batch["nodes"], batch["words"], strict=True):
                base = [tuple(int(x) for x in flat[k : k + 3]) for k in range(0, len(flat), 3)]
                nodes, more = _nodes_of(value), []
                if any(
                    y == OTHER and bits != 1 << OTHER
                    for y, bits in zip(nodes["label"], nodes["allowed"], strict=True)
                ):
                    best, belief = sent.value.label(nodes)
                    more = added_spans(
                        nodes, base, best, belief, lambda a, b, w=words: " ".join(w[a:b]), sure
                    )
                base_out.append([(KINDS[k], a, b) for k, a, b in _order(base)])
                all_out.append([(KINDS[k], a, b) for k, a, b in _order(base + more)])
            yield pd.DataFrame({"id": batch["id"], "base": _dicts(base_out), "spans": _dicts(all_out)})

    span = "array<struct<kind:string,start:int,end:int>>"
    found = scanned.mapInPandas(run, f"id {kind}, base {span}, spans {span}")
    return from_pandas(found, "id", narrow)


def _dicts(rows):
    return [[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in rows]


def _joined(column: str) -> F.Column:
    return F.array_join(
        F.transform(
            F.col(column), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def op10_crf(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = [
        F.expr(f"size(filter(base, s -> s.kind = '{kind}'))").cast("long").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return find(docs).select(
        F.col("id").alias("doc_id"),
        *counts,
        F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )


def digest(spans: list[tuple[int, int, int]]) -> str:
    """What the query gives for a document's base spans; for tests."""
    return hashlib.sha256(joined(spans).encode()).hexdigest()
