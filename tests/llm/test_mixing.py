import math

import pytest

from feedpulse.llm import mixing


@pytest.fixture(scope="module")
def sources(make_docs):
    sizes = {"big": 400, "middle": 90, "small": 30, None: 10}
    rows, i = [], 0
    for source, n in sizes.items():
        for k in range(n):
            rows.append((i, "w " * (1 + k % 7), source))
            i += 1
    return make_docs(*rows)


def tokens(text):
    return len((text or "").split())


def plan(rows, max_repeats=None, entropy=None, scale=None):
    """The weights by plain bisection."""
    total = {}
    for r in rows:
        total[r["source"]] = total.get(r["source"], 0) + tokens(r["text"])
    share = {s: t / sum(total.values()) for s, t in total.items() if t}

    def at(a):
        z = sum(p**a for p in share.values())
        weight = {s: p**a / z for s, p in share.items()}
        size = max(share[s] / weight[s] for s in share) if scale is None else scale
        times = {s: weight[s] * size / share[s] for s in share}
        return weight, times, -sum(w * math.log(w) for w in weight.values())

    def meets(a):
        _, times, h = at(a)
        return (max_repeats is None or max(times.values()) <= max_repeats + 1e-9) and (entropy is None or h <= entropy + 1e-9)

    low, high = 0.0, 1.0
    if meets(0.0):
        return at(0.0)
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if meets(middle) else (middle, high)
    return at(high)


@pytest.mark.parametrize(
    "limits", [{"max_repeats": 2.0}, {"max_repeats": 100.0}, {"max_repeats": None, "entropy": 1.0}, {"max_repeats": 3.0, "scale": 1.5}]
)
def test_budgets_like_brute_force(sources, limits):
    rows = sources.collect()
    _, times, _ = plan(rows, **{"max_repeats": None, **limits})
    mixed = mixing.mixture(sources, **limits).collect()
    for source, want in times.items():
        own = [r for r in rows if r["source"] == source]
        all_tokens = sum(tokens(r["text"]) for r in own)
        copies = [r for r in mixed if r["source"] == source]
        got = sum(tokens(r["text"]) for r in copies)
        # Below the budget by less than a document.
        assert want * all_tokens - 8 <= got <= want * all_tokens + 1e-6 * all_tokens
        per_doc = {}
        for r in copies:
            per_doc.setdefault(r["doc_id"], []).append(r["epoch"])
        assert all(sorted(e) == list(range(len(e))) for e in per_doc.values())
        numbers = [len(per_doc.get(r["doc_id"], [])) for r in own]
        assert max(numbers) - min(numbers) <= 1


def test_every_document_by_default(sources):
    mixed = mixing.mixture(sources)
    assert mixed.select("doc_id").distinct().count() == sources.count()


def test_cut_is_found_in_any_block(sources, monkeypatch):
    whole = {(r["doc_id"], r["epoch"]) for r in mixing.mixture(sources, max_repeats=2.5).collect()}
    monkeypatch.setattr(mixing, "DOCS_IN_BLOCK", 7)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert {(r["doc_id"], r["epoch"]) for r in mixing.mixture(sources, max_repeats=2.5).collect()} == whole


def test_tables(messy, clashing, make_docs):
    mixed = mixing.mixture(clashing)
    assert {*clashing.columns} | {"epoch", "block", "place"} == {*mixed.columns}
    assert mixed.where("epoch = 0").count() == clashing.count()
    assert mixing.mixture(messy.limit(0)).collect() == []
    blank = make_docs((1, ""), (2, None))
    assert mixing.mixture(blank).count() == 2
