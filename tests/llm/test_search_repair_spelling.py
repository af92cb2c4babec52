"""Operators 11 to 13 against plain Python, on odd rows and on rows that take every path."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lumentab.llm import mtree, spelling, turns

# ---------------------------------------------------------------- exact top-k search


def plain_top_k(rows, k=20, every=20):
    whole = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole.append((i, [int(np.floor(64 * float(x))) for x in v]))
    out = []
    for n, (i, q) in enumerate(whole):
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, x)), j) for m, (j, x) in enumerate(whole) if m != n)
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def searched(spark, rows, **more):
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, q int, block string").repartition(3)
    return sorted(tuple(r) for r in mtree.top_k(table, **more).collect())


@pytest.mark.parametrize("subtree", [mtree.SUBTREE, 40])
def test_top_k_equals_all_pairs(spark, monkeypatch, subtree):
    monkeypatch.setattr(mtree, "SUBTREE", subtree)
    monkeypatch.setattr(mtree, "BLOCK", 7)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 5))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] + 0.05 * rng.normal(size=5)]) for i in range(300)]
    # A vector a third of all rows share, short, empty, null and unsound ones, and repeated rows.
    rows += [(i, [0.5, 0.5, 0.0, 0.0, 1.0]) for i in range(300, 460)] + [(460, [1.0]), (480, []), (500, None), (520, [1.0, None]), (540, [float("nan")])]
    rows += [(560, [float("inf"), 1.0]), (None, [1.0, 2.0]), rows[20], rows[20], rows[21], (580, [-3.0, 0.0, 2.0, 0.0, 0.0])]
    assert searched(spark, rows) == plain_top_k(rows)


def test_top_k_of_few_and_no_rows(spark):
    assert searched(spark, []) == []
    assert searched(spark, [(0, None), (20, [None])]) == []
    assert searched(spark, [(0, [1.0])]) == [] and searched(spark, [(1, [1.0])]) == []
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [0.0, 1.0])]
    assert searched(spark, rows) == plain_top_k(rows)


def test_large_scores_are_exact(spark):
    rows = [(i, [float(1 << 22) + i, float(i)]) for i in range(30)]
    assert searched(spark, rows) == plain_top_k(rows)
    with pytest.raises(OverflowError):
        searched(spark, [(0, [1e30]), (1, [1e30])])


def test_bounds_spare_distances():
    rng = np.random.default_rng(1)
    x = np.concatenate([c + rng.integers(-3, 4, size=(200, 8)) for c in 60 * rng.normal(size=(20, 8))]).astype(np.int64)
    space = mtree.Space(8, int((x * x).sum(axis=1).max()) + 1, int(np.abs(x).max()))
    lifted = space.lifted(x)
    chosen = mtree.spread_pivots(space, x, 40)
    d = space.between(lifted, lifted[chosen])
    home = d.argmin(axis=1)
    leaf = []
    for p in range(len(chosen)):
        own = np.flatnonzero(home == p)
        if len(own):
            leaf.append((own.tobytes(), x[own].tobytes(), d[own, p].tobytes(), x[chosen[p]].tobytes(), float(d[own, p].max())))
    q = x[::50]
    who, what, score, computed = mtree.search(space, leaf, q, np.full(len(q), np.inf), 5)
    full = q @ x.T
    for n in range(len(q)):
        best = sorted(zip(-full[n], range(len(x))))[:5]
        assert list(zip(-score[who == n], what[who == n])) == best
    assert computed < 0.5 * len(q) * len(x)


# ---------------------------------------------------------------- conversation repair

def every_edit(initials, faults):
    """The least (cost, audit) of all edits within the greedy cost."""
    bound, found = turns.greedy_cost(initials, faults), []

    def go(i, last, cost, audit):
        if cost > bound:
            return
        if i == len(initials) and last in ("", "a"):
            found.append((cost, audit))
        want = "a" if last == "u" else "u"
        go(i, want, cost + 3, audit + "I")
        if i < len(initials):
            go(i + 1, last, cost + 4, audit + "D")
            if faults[i] not in (turns.BLANK, turns.DUPLICATE):
                fix = 3 * (faults[i] == turns.TRUNCATED)
                if not last and initials[i] == "s":
                    go(i + 1, "s", cost + fix, audit + "K")
                go(i + 1, want, cost + fix + 3 * (initials[i] != want), audit + ("K" if initials[i] == want else "R"))

    go(0, "", 0, "")
    return min(found)


def test_band_states_and_all_edits_agree():
    rng = random.Random(3)
    for _ in range(1500):
        n = rng.randint(0, 6)
        initials = "".join(rng.choice("suauau\0t") for _ in range(n))
        faults = bytes(rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))
        want = every_edit(initials, faults)
        assert turns.repair(initials, faults) == want == turns.by_states(initials, faults)


def test_long_conversations_agree_on_both_ways(monkeypatch):
    rng = random.Random(8)
    for n in (60, 400):
        initials = "".join(rng.choice("uauauats") for _ in range(n))
        faults = bytes(rng.choice([0, 0, 0, 0, 1, 2, 3]) for _ in range(n))
        banded = turns.repair(initials, faults)
        monkeypatch.setattr(turns, "CELLS", 0)
        assert banded == turns.repair(initials, faults)
        monkeypatch.undo()


def plain_repair(rows):
    """The contract, row by row."""
    by_conv, names = defaultdict(list), set()
    space = lambda x: " " if x is None else x
    for conv, turn, role, text in rows:
        names.add(conv)
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        by_conv[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv in names:
        own = sorted(by_conv[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        faults, seen = bytearray(), set()
        for _, role, text in own:
            last = re.findall("[^\x20\x09-\x0D]", text)
            faults.append(1 if not last else 2 if (role, text) in seen else 3 if last[-1] not in ".!?" else 0)
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in own]
        cost, audit = turns.by_states([c or "\0" for c in initials], bytes(faults)) if len(own) > 8 else every_edit([c or "\0" for c in initials], bytes(faults))
        lines, i, last = [], 0, ""
        for letter in audit:
            role, text = ("", "")
            if letter != "I":
                _, role, text = own[i]
                i += 1
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if last == "u" else "user"
            last = role[:1]
            lines.append(f"{role}:{text}")
        numbers = [t for t, *_ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((conv, gaps, *(faults.count(f) for f in (1, 2, 3)), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def repaired(spark, rows):
    table = spark.createDataFrame([(*r, 7, "y") for r in rows], "conv_id long, turn long, role string, text string, copy int, audit string").repartition(3)
    return sorted((tuple(r) for r in turns.repaired(table).collect()), key=str)


def test_repair_equals_plain_python(spark):
    rng = random.Random(6)
    said = ["Yes.", "No!", "cut", " ", "", "Why? ", "é. x", None, "a\nb.", "Yes."]
    rows = [(c, t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(said))
            for c in range(150) for t in range(rng.randint(1, 7))]
    rows += [(None, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(5)] + [(None, None, None, None)] + [(200, None, "user", "x.")] * 2
    rows += [(201, t % 3, "user", f"same turn {t}.") for t in range(6)] + [(202, 1, "user", "word. " * 50_000)] + rows[:9]
    rows += [(203, t, rng.choice(["user", "assistant"]), rng.choice(said)) for t in range(300)]
    assert repaired(spark, rows) == plain_repair(rows)


def test_repair_of_dropped_rows_and_no_rows(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repaired(spark, [(conv, 0, "user", "gone.")])
    assert got == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repaired(spark, []) == []


def test_repair_query_equals_plain_python(spark):
    pytest.importorskip("pyarrow")
    from lumentab.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in queries.QUERIES["op12_turn_repair"](spark, sf).collect()), key=str)
    assert got == plain_repair(rows)


# ---------------------------------------------------------------- spelling variants

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def plain_variants(docs):
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


@pytest.fixture(scope="module")
def spelled():
    rng = random.Random(11)
    letters = "abcdeéñÿ×ort"
    words = ["".join(rng.choice(letters[:5] if k % 3 else letters) for _ in range(rng.randint(6, 11))) for k in range(150)]
    words += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "abababa", "Ferdinand", "ferdinand", "FERDINANT", "a" * 3000, "a" * 3001]
    for w in words[:60]:
        k, c = rng.randrange(len(w)), rng.choice(letters)
        words += [w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:]]
    docs = []
    for d in range(60):
        docs.append((d, " ".join(w for w in words for _ in range(rng.choice([0, 0, 1, 1, 2]))) + " x1" + rng.choice([". ", "-", "_"]) + "Rare"))
    docs += [(90 + k, "internationalization " * (1500 if k else 3) + "internationalisation " * 60 + "internationalisatlon internationalisatlon") for k in range(2)]
    return docs + [(None, "internationalization " * 9), (100, None), (101, ""), (102, " 123 "), docs[0]]


@pytest.mark.parametrize("hot", [spelling.HOT, 2])
def test_variants_equal_plain_python(spark, monkeypatch, spelled, hot):
    monkeypatch.setattr(spelling, "HOT", hot)
    table = spark.createDataFrame([(d, t, 1, "z") for d, t in spelled], "doc_id long, text string, n int, word string").repartition(3)
    got = sorted(tuple(r) for r in spelling.variants(table).collect())
    want = plain_variants(spelled)
    assert got == want and any(f for _, f, *_ in want) and any(f and r != f for _, f, r, *_ in want)


def test_variants_of_no_words(spark):
    table = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(table).collect() == []
    table = spark.createDataFrame([(1, None), (2, "short words here")], "doc_id long, text string")
    assert spelling.variants(table).collect() == []


def test_pivots_are_disjoint_and_cheapest_in_the_prefix():
    rng = np.random.default_rng(2)
    letters = rng.integers(0, 6, size=(400, 9))
    counts = rng.integers(1, 1000, size=spelling.LETTERS ** 2)
    rank = np.argsort(np.argsort(counts, kind="stable"), kind="stable")
    prefix, first, second = spelling.prefix_and_pivots(letters, rank, counts)
    grams = letters[:, :-1] * spelling.LETTERS + letters[:, 1:]
    for w in range(len(letters)):
        places = np.flatnonzero(prefix[w])
        assert len(places) >= spelling.PREFIX
        want = min(counts[grams[w, i]] + counts[grams[w, j]] for i in places for j in places if j >= i + 2)
        assert second[w] >= first[w] + 2 and counts[grams[w, first[w]]] + counts[grams[w, second[w]]] == want
