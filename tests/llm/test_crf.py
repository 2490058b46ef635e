import random
import re

import numpy as np
import pandas as pd
import pytest

from lectern.llm import crf

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """The patterns as they are written, and their checks."""
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and crf.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


def test_base_spans_on_random_text():
    rng = random.Random(6)
    parts = ["a", "b.c", "@", "@x", ".com", ".", "1", "22", "255", "256", "0", " ", "-", "+", "(", ")", "4111111111111111",
             "_", "é", "1.2.3.4", "+1 (988) 555-2485", "a@b.c", "%", "\n", "00007"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 14)))
        assert crf.base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["", "@", "a" * 200_000 + "@", "1" * 200_000, "+" * 100_000, "1." * 100_000, "@a" * 50_000])
def test_long_and_odd_texts(text):
    crf.graph(text, crf.base_spans(text))


def test_luhn():
    assert crf.luhn("4111111111111111") and not crf.luhn("4111111111111112")


def test_shapes_are_of_whole_tokens():
    start = "1." * 100
    assert len({crf.shape(start + end) for end in ("a", "-", "22", "@x", "")}) == 5
    assert crf.shape("+" * 9 + "12-3") == crf.shape("45-6") != crf.shape("45-66")
    assert crf.shape("ab@cde") == crf.shape("x@y")


def test_message_passing_is_exact_on_a_tree():
    """Beliefs of a chain with one skip link that closes no loop, against all labellings."""
    rng = np.random.default_rng(7)
    field = crf.Field(rng.normal(size=(crf.SHAPES, crf.LABELS)), rng.normal(size=(5, 5)), rng.normal(size=(5, 5)))
    nodes = {
        "shape": [3, 4, 5, 6], "allowed": [31, 31, 19, 31], "label": [4, 4, 4, 1],
        "chain": [0, 1, 0, 1], "skip": [-1, -1, 0, -1], "start": [0] * 4, "end": [0] * 4,
    }
    best, belief = field.label(nodes)
    total = np.zeros((4, 5))
    for y in np.ndindex(5, 5, 5, 5):
        if y[3] != 1 or any(not nodes["allowed"][k] >> y[k] & 1 for k in range(3)):
            continue
        e = sum(field.node[nodes["shape"][k], y[k]] for k in range(3))
        e += field.chain[y[0], y[1]] + field.chain[y[2], y[3]] + field.skip[y[0], y[2]]
        for k in range(4):
            total[k, y[k]] += np.exp(e)
    total /= total.sum(axis=1, keepdims=True)
    assert best.tolist() == total.argmax(axis=1).tolist()
    assert belief == pytest.approx(total.max(axis=1), abs=1e-3)


NUMBERS = [f"({200 + k}) 555-{1000 + 7 * k}" for k in range(60)]


def texts():
    rows = [(k, f"word more +1 {n} and later words") for k, n in enumerate(NUMBERS)]
    rows += [(100 + k, f"list {k}. item {k * 37} of {k + 3}, 12.5 or {k}{k}") for k in range(60)]
    rows += [
        (200, "call +1 (988) 555-2485 today or (988) 555-2485 at night"),
        (201, "no number 7 of 12, only 3.14"), (202, None), (203, ""), (None, "a@b.co"), (203, ""),
        (204, "x 1.2.3.4 " + "word " * 60000 + "4111 1111 1111 1111"),
    ]
    return rows


def test_find(spark):
    rows = texts()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, spans int")
    got = crf.find(df).collect()
    assert len(got) == len(rows)
    by = {r["id"]: r for r in got}
    kinds = {k: n for n, k in enumerate(crf.KINDS)}
    for doc_id, text in rows:
        base = [(kinds[s["kind"]], s["start"], s["end"]) for s in by[doc_id]["base"]]
        assert base == plain(text)
        assert {tuple(s) for s in by[doc_id]["base"]} <= {tuple(s) for s in by[doc_id]["spans"]}
    # the number is found again without its prefix, and plain numbers are left alone
    again = [s for s in by[200]["spans"] if s not in by[200]["base"]]
    text = dict(rows)[200]
    assert [(s["kind"], text[s["start"] : s["end"]]) for s in again] == [("phone", "(988) 555-2485")]
    for k in [*range(100, 160), 201]:
        assert list(by[k]["spans"]) == []


def test_empty(spark):
    assert crf.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    field = crf.Field.fit(pd.DataFrame(columns=["shape", "before", "after", "linked", "label", "n"]))
    assert field.node.shape == (crf.SHAPES, crf.LABELS)


def test_short_ip_addresses_are_linked():
    """Fewer than seven digits, written with and without brackets, also behind another number."""
    text = "10.0.0.1 and 8.8.8.8 then 10.0.0[.]1 or 12345 10.0.0.1 not 10.0.0.2 nor 10001 but 8.8.8.8"
    nodes = crf.graph(text, crf.base_spans(text))
    assert nodes["skip"] == [-1, -1, 0, -1, 2, -1, -1, 1]
