"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumentab.llm import dac, decontaminate, language, licenses, mixing, ngramjoin, pieces, quality, secret_scan, templates, tokencount, words

BENCH = "item_id long, text string, n int"


def texts(odd_rows):
    return [(r[0], r[1] or "") for r in odd_rows]


def by_id(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) if not isinstance(x, bool) else (True, int(x)) for x in r))


def test_words_are_those_of_the_patterns(odd_rows):
    import pyarrow as pa

    own = [t for _, t in texts(odd_rows)] + ["ÀB c\x85d　e A1_b", "\x00x"]
    buf, offsets = words.text_buffers(pa.array([None, *own]).slice(1))
    for kind, pattern in ((words.SPACED, r"[^\x20\x09-\x0D]+"), (words.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        fold = (lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)) if kind is words.ALNUM else str
        for lo, hi in words.blocks(offsets, 1000):
            cut = words.Cut(buf, offsets[lo:hi + 1], kind)
            for k in range(hi - lo):
                got = [words.LOWER[cut.bytes[cut.starts[w]:cut.ends[w]]] if kind is words.ALNUM else cut.bytes[cut.starts[w]:cut.ends[w]]
                       for w in range(cut.first[k], cut.first[k + 1])]
                assert [g.tobytes().decode() for g in got] == re.findall(pattern, fold(own[lo + k]))


def brute_hits(text, items, window=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    own, hit, found = low(text), set(), set()
    for i, t in items:
        w = low(t)
        k = min(window, len(w))
        for p in range(len(w) - k + 1 if w else 0):
            for q in range(len(own) - k + 1):
                if own[q:q + k] == w[p:p + k]:
                    hit.update(range(q, q + k))
                    found |= {str(i)} if i is not None else set()
    return len(own), len(hit), ",".join(sorted(found))


def test_decontamination(spark, odd, odd_rows, none):
    item = " ".join((odd_rows[4][1]).split()[20:50]).upper()
    items = [(1, item), (2, "Wort"), (10, "und noch ein"), (3, None), (4, "..."), (None, "one"), (5, item), (6, "a b c d a b c d a b c d a")]
    bench = spark.createDataFrame([(*i, 0) for i in items], BENCH)
    got = decontaminate.contamination(odd, bench).collect()
    small = [r for r in odd_rows if r[0] != 8]
    want = by_id([(r[0], *brute_hits(r[1], items)) for r in small])
    assert by_id([(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got if r.doc_id != 8]) == want
    left = decontaminate.remove_contaminated(odd, bench)
    assert left.columns == odd.columns
    assert left.count() == sum(r.n_hit == 0 for r in got)
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(odd, bench.limit(0)).where("contaminated").count() == 0
    match = [r for r in decontaminate.longest_matches(odd, bench).where("item_id = '1'").collect() if r.doc_id == 5]
    assert [(m.doc_word, m.item_word, m.n_words) for m in match] == [(20, 0, 30)]


def test_decontamination_in_blocks_of_items(spark, odd, odd_rows, monkeypatch):
    own = odd_rows[4][1].split()
    bench = spark.createDataFrame([(i, " ".join(own[i * 9:i * 9 + 15]), 0) for i in range(8)], BENCH)
    one = decontaminate.contamination(odd, bench).collect()
    monkeypatch.setattr(decontaminate.probes, "__defaults__", (100,))
    assert by_id(map(tuple, decontaminate.contamination(odd, bench).collect())) == by_id(map(tuple, one))
    assert any(r.n_items == "8" or r.n_items == 8 for r in one)


def test_suffix_search_finds_every_window_of_random_words():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    docs = [" ".join(map(str, rng.integers(0, 3, rng.integers(0, 60)))) for _ in range(40)]
    items = [(i, " ".join(map(str, rng.integers(0, 4, rng.integers(1, 14))))) for i in range(15)]
    probe = decontaminate.build_probe(items, 5)
    buf, offsets = words.text_buffers(pa.array(docs))
    cut = words.Cut(buf, offsets, words.ALNUM)
    window, row, word = decontaminate.search_block(cut, probe)
    got = set()
    for v, r, w in zip(window, row, word, strict=True):
        got |= {(k, int(r), int(w - cut.first[r])) for k, _ in probe.places[v]}
    want = set()
    for k, t in items:
        w = t.split()
        n = min(5, len(w))
        for r, d in enumerate(docs):
            d = d.split()
            want |= {(k, r, q) for q in range(len(d) - n + 1) for p in range(len(w) - n + 1) if d[q:q + n] == w[p:p + n]}
    assert got == want


def components(rows, width=4, percent=85):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(tuple(w[p:p + width]) for p in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    part = {i: i for i in sets}
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * len(sets[a] | sets[b]) and part[a] != part[b]:
                low, high = sorted((part[a], part[b]))
                part = {i: low if p == high else p for i, p in part.items()}
    return {i: (len(sets[i]), part[i]) for i in sets}


def test_ngram_join(odd, odd_rows, none):
    want = components([(r[0], r[1]) for r in odd_rows if r[0] is not None])
    got = ngramjoin.jaccard_components(odd).collect()
    assert len(got) == len(odd_rows)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got if r.doc_id is not None)
    assert all(r.component_id is None for r in got if r.doc_id is None)
    kept = ngramjoin.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for _, c in want.values()})
    assert kept.where("doc_id IS NULL").count() == 2
    assert ngramjoin.jaccard_components(none).count() == 0


@pytest.mark.parametrize("tile", [4, 512])
def test_ngram_join_of_a_large_family(spark, monkeypatch, tile):
    """Copies of one base that mostly do not link each other, chains, and short texts; with many small tiles too."""
    monkeypatch.setattr(ngramjoin, "TILE", tile)
    rng = np.random.default_rng(8)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(60):
        own = list(base)
        for k in rng.integers(0, 150, rng.integers(0, 7)):
            own[k] = f"x{i}_{k}"
        rows.append((i + 1, " ".join(own)))
    rows += [(100 + k, " ".join(f"c{n}" for n in range(k, k + 40 + k % 3))) for k in range(25)]
    rows += [(200 + k, " ".join("ab"[n] for n in rng.integers(0, 2, rng.integers(1, 9)))) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = components(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.jaccard_components(docs).collect()}
    assert got == want
    assert 1 < len({c for _, c in want.values()}) < len(rows)


def test_rows_of_one_id_are_one_document(spark):
    one, two = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    docs = spark.createDataFrame([(1, one), (5, one), (5, two), (7, two), (9, "other")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in ngramjoin.jaccard_components(docs).collect()}
    assert got == {(1, 1), (5, 1), (7, 1), (9, 9)}
    assert sorted(r.doc_id for r in ngramjoin.keep_one(docs).collect()) == [1, 9]


def test_signatures_bound_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**63, 200, dtype=np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, int(rng.integers(0, 200)), dtype=np.uint64))))
        x, y = ngramjoin.signature(a), ngramjoin.signature(b)
        while len(x) != len(y):
            if len(x) < len(y):
                y = y[:len(y) // 2] ^ y[len(y) // 2:]
            else:
                x = x[:len(x) // 2] ^ x[len(x) // 2:]
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_quality(odd, odd_rows, none):
    got = quality.judge(odd).collect()
    assert len(got) == len(odd_rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].n_words == 0 and by[1].base_failed and not by[1].kept
    assert (by[12].n_words, by[12].n_dup_lines) == (4, 3)
    assert by[11].n_repeat_words == 160 and by[11].base_failed
    assert by[8].n_words == 30_000 and by[8].kept
    assert (by[9].n_words, by[9].word_chars) == (9, len("".join(odd_rows[11][1].split())))
    left = quality.filter_documents(odd)
    assert left.columns == odd.columns and left.count() == sum(r.kept for r in got)
    assert quality.judge(none).count() == 0 and quality.filter_documents(none).count() == 0


def test_strict_hosts(spark):
    good = " ".join(f"word{k}" for k in range(40))
    marks = " ".join(f"word{k} #" for k in range(40))
    rows = [(i, good if i % 10 == 0 else marks, "bad") for i in range(100)] + [(100 + i, marks if i % 10 == 0 else good, f"ok{i % 4}") for i in range(200)]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert [i for i in range(100) if got[i].kept] == list(range(0, 100, 10))
    assert all(got[i].kept for i in range(100, 300))


def test_secrets(spark, odd, odd_rows, none):
    key = "AKIA" + "B7" * 10
    rows = [
        (1, f"é password = 'abc123def' {key} token: abc token=abcdefgh"), (2, None), (3, "deadbeef" * 3 + "z" + "0" * 23),
        (4, ("secret: value_%d " * 1) % 7 + "api_key=xyz"), (5, "SeCrEt=token : abcdefg"), (6, " ".join(f"token={k:06d}" for k in range(500))),
        (7, "ghp_" + "a1" * 20 + " 😀 passwd:abcdef"), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    forms = [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24),
             ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1)]

    def spans(text):
        found = [(m.start(), n, f"{kind}:{m.start()}:{m.end()}") for n, (kind, form, group, least) in enumerate(forms)
                 for m in re.finditer(form, text or "", re.A) if len(m[group]) >= least]
        return ",".join(x[2] for x in sorted(found))

    got = secret_scan.scan(docs).collect()
    assert by_id([(r.doc_id, r.spans) for r in got]) == by_id([(i, spans(t)) for i, t in rows])
    assert secret_scan.scan(odd).count() == len(odd_rows) and secret_scan.scan(none).count() == 0


def test_trigram_queries():
    q = {r.kind: secret_scan.trigram_query(r.pattern) for r in secret_scan.RULES}
    assert q["hex"] is None
    assert q["access"] == [frozenset({"aki", "kia"})]
    assert frozenset({"tok", "oke", "ken"}) in q["assign"] and len(q["assign"]) == 6


def test_licences(spark, odd, odd_rows, none):
    mit = "\n".join(licenses.SENTENCES[k][0] + "." for k in ("MIT_GRANT", "MIT_NOTICE", "MIT_AS_IS", "MIT_LIABILITY"))
    rows = [(1, f"The MIT License (MIT)\n\nCopyright me\n\n{mit}"), (2, "text. Licensed under CC BY-NC 4.0. more"), (3, None), (4, "All rights reserved."),
            (5, "Released under the MIT License. x\nLicensed under the Apache License, Version 2.0"), (6, licenses.SENTENCES["GPL3_LATER"][0]),
            (7, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")]
    got = {r.doc_id: (r.licenses, r.unmatched_ids) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("MIT", ""), 2: ("CC-BY-NC-4.0", ""), 3: ("", ""), 4: ("", "ALL_RIGHTS"), 5: ("Apache-2.0,MIT", ""), 6: ("", "GPL3_LATER"), 7: ("GPL-3.0-or-later", "")}
    assert licenses.scan(odd).count() == len(odd_rows) and licenses.scan(none).count() == 0


def test_license_tags_are_told_apart(spark):
    tags = [(s.partition(": ")[2], name) for name, own in licenses.SENTENCES.items() for s in own if s.startswith("SPDX")]
    names = {name: rule for rule, ids in reversed(licenses.RULES) for name in ids if ids == [name]} | {"APACHE2_REF": "Apache-2.0"}
    rows = [f"{lead}SPDX-License-Identifier: {tag}{tail}" for tag, _ in tags for lead, tail in (("", ""), ("# ", "\nimport os"), ("/* ", " */\nint x;"))]
    rows += ["SPDX-License-Identifier: LicenseRef-Proprietary", "SPDX-License-Identifier: ", "MIT", "Mozilla Public License, v. 1.1"]
    got = licenses.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert len(tags) == 16
    assert [(r.sentence_ids, r.licenses) for r in got] == [(name, names[name]) for _, name in tags for _ in range(3)] + [("", "")] * 4


def test_rules_with_long_literals_have_candidates(spark):
    literal = "".join(f"{chr(97 + n % 26)}{n:02d}" for n in range(30))
    query = secret_scan.trigram_query(literal)
    assert [len(a) for a in query] == [88]
    docs = spark.createDataFrame([(1, f"x {literal.upper()} y"), (2, literal[:30]), (3, "")], "key long, text string")
    got = secret_scan.candidates(docs, {"long": query, "short": secret_scan.trigram_query("a00b01")}).collect()
    assert {r.key: sorted(r.kinds) for r in got} == {1: ["long", "short"], 2: ["short"]}


def test_wrapped_licenses_are_found(spark):
    import textwrap

    wrap = lambda s, lead, end="\n": end.join(textwrap.wrap(s, 72, initial_indent=lead, subsequent_indent=lead))
    known = [(s, name) for name, own in licenses.SENTENCES.items() for s in own]
    forms = [("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("// ", "\n")]
    rows = [f"Some title\n{wrap(s, *f)}{f[1]}{f[0]}and so on" for s, _ in known for f in forms]
    got = licenses.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.sentence_ids for r in got] == [name for _, name in known for _ in forms]
    for rule, ids in licenses.RULES:
        own = [licenses.SENTENCES[x.rstrip("?")][0] + "." for x in ids]
        # The second GPL2_LATER is the other part of the sentence.
        own = [licenses.SENTENCES["GPL2_LATER"][1] + "." if x == "GPL2_LATER?" else s for x, s in zip(ids, own, strict=True)]
        rows = [(f"{f[1]}{f[0].rstrip()}{f[1]}" if blank else f[1]).join(wrap(s, *f) for s in own) for f in forms for blank in (True, False)]
        got = licenses.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
        assert {(r.licenses, r.unmatched_ids) for r in got} == {(rule, "")}
    long = known[4][0]
    apart = licenses.scan(spark.createDataFrame([(1, "MIT\n\nLicense"), (2, "MIT\n#\nLicense"), (3, "a\x02b\n\n" + "\n" * 100_000 + long)], "doc_id long, text string"))
    assert {r.doc_id: (r.n_sentences, r.n_known) for r in apart.collect()} == {1: (2, 0), 2: (2, 0), 3: (2, 1)}


def test_language(odd, odd_rows, none):
    got = language.identify(odd).collect()
    assert len(got) == len(odd_rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3, 10))
    assert by[8].lang_pred == "en"
    assert language.identify(none).count() == 0
    assert {r.lang_pred for r in language.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_vectors_follow_their_definition():
    texts = ["Ab, ba", "", "12", "b" * 3, "x" + "y" * 700]
    got = language.text_vectors(texts)
    for text, vector in zip(texts, got, strict=True):
        symbols = f" {' '.join(re.findall('[a-z]+', text.lower()))} " if re.search("[a-zA-Z]", text) else ""
        want = np.zeros(language.WIDTH)
        for a, b, c in zip(symbols, symbols[1:], symbols[2:], strict=False):
            v = [language._letter_vector(ord(s)).astype(float) for s in (a, b, c)]
            want += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
        assert (vector == want).all()


def test_token_counts(odd, odd_rows, none):
    tokenizers = pytest.importorskip("tokenizers")
    tok = tokenizers.Tokenizer.from_file(pieces.tokenizer_path())
    got = tokencount.count_tokens(odd).collect()
    want = [(i, len(t.encode()), len(tok.encode(t, add_special_tokens=False).ids)) for i, t in texts(odd_rows)]
    assert by_id([(r.doc_id, r.n_bytes, r.n_tokens) for r in got]) == by_id(want)
    assert tokencount.count_tokens(none).count() == 0


def test_pieces_join_to_whole_texts(monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    import pyarrow as pa

    tok = tokenizers.Tokenizer.from_file(pieces.tokenizer_path())
    own = ["it's <|endoftext|> á ́b c　d <|startoftext|>x İstanbul ΣΑΣ é", "", "  ", "1234 a1b2'll", None, "\U0001F600 ‍!"]
    buf, offsets = words.text_buffers(pa.array(own))
    monkeypatch.setattr(pieces, "KNOWN", 5)
    table = pieces.PieceTable(pieces.tokenizer_path())
    ids, sizes = table.encode(buf, offsets, 2)
    want = [[*tok.encode(t or "", add_special_tokens=False).ids, 2] for t in own]
    assert ids.tolist() == [x for w in want for x in w] and sizes.tolist() == [len(w) for w in want]
    assert table.lengths(buf, offsets).tolist() == [len(w) - 1 for w in want]


def test_token_file(spark, odd, odd_rows, none, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    tok = tokenizers.Tokenizer.from_file(pieces.tokenizer_path())
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in dac.token_file(odd, folder=str(tmp_path / "t")).collect())
    assert [x[1] for x in got] == [None, None, 1, 2, 3, 4, 5, 6, 6, 7, 8, 9, 10, 11, 12, 13]
    crc = lambda t: zlib.crc32(np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes())
    assert by_id([(x[1], x[3]) for x in got]) == by_id([(i, crc(t)) for i, t in texts(odd_rows)])
    assert [x[0] for x in got] == np.cumsum([0, *(x[2] for x in got)])[:-1].tolist()
    assert dac.token_file(none).count() == 0


def test_codes_give_every_id():
    rng = np.random.default_rng(2)
    for ids in (np.array([], np.uint32), np.array([0]), np.array([2**32 - 1]), rng.integers(0, 300, 5000), rng.integers(0, 2**32, 3000), rng.integers(0, 200, 129)):
        codes = dac.Codes(dac.encode(ids.astype(np.uint32)))
        assert len(codes) == len(ids) and codes.read(0, len(ids)).tolist() == ids.tolist()
        for i in rng.integers(0, max(1, len(ids)), 200) if len(ids) else []:
            assert codes[int(i)] == ids[i]
        for _ in range(20 if len(ids) else 0):
            lo, hi = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
            assert codes.read(lo, hi).tolist() == ids[lo:hi].tolist()


def test_mixing(spark, odd, odd_rows, none):
    got = mixing.mix(odd).collect()
    filled = {r[0] for r in odd_rows}
    assert {r.doc_id for r in got} == filled
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    assert sorted(str(r.doc_id) for r in mixed.collect()) == sorted(str(r.doc_id) for r in got)
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_mixture_weights(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "w " * int(rng.integers(1, 40)), "big" if i % 3 else f"s{i % 8}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(t.split())
    total = sum(size.values())

    def tokens(**options):
        out = {}
        for r in mixing.mix(docs, **options).collect():
            out[r.source] = out.get(r.source, 0) + r.n_tokens
        return out

    got = tokens(repeats=3.0)
    times = {s: got[s] / size[s] for s in size}
    assert times["big"] == 1 and 2.8 < max(times.values()) <= 3.0
    # A fixed budget is met from below, by less than a document per source.
    got = tokens(budget=total / 2, repeats=None, entropy=1.5)
    assert total / 2 - 40 * len(size) <= sum(got.values()) <= total / 2
    share = np.array(list(got.values())) / sum(got.values())
    assert abs(-(share * np.log(share)).sum() - 1.5) < 0.02


PAGE = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><div class="cookie-notice">We use cookies</div>
<div id="menu"><a href="/">Home</a></div><div class="content"><h1>{n} A &amp; B</h1><p>Body&nbsp;{n}  text <b>bold</b>{n}.<p>Second &lt;{n}&gt;<aside>side</aside></div>
<div class="promo">Buy now</div><div class="box">Always the same</div><section class="comments"><p>nice {n}</p></section></body></html>"""


def test_templates(spark, none):
    rows = [(i, "http://host.example/x", PAGE.format(n=i)) for i in range(12)] + [
        (20, "http://other.example/", "<p>alone<br>here <script>x"), (21, None, None), (22, "bad url", "plain & simple &am"), (20, "http://other.example/", "<p>alone<br>here <script>x"),
        (23, "http://third.example", "<article><header>h</header><p>in <form>f</form>out</p><!-- c --><nav>n</nav></article><p>rest" + "<p>more" * 2000)]
    got = templates.extract(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for i in range(12):
        assert by[i].text == f"{i} A & B\n\nBody {i} text bold{i}.\n\nSecond <{i}>"
    assert by[20].text == "alone here" and by[21].text == "" and by[21].n_chars == 0 and by[22].text == "plain & simple &am"
    assert by[23].text.startswith("in\n\nout")
    assert templates.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_a_host_of_copies_keeps_its_article(spark):
    page = "<html><body><nav>n</nav><article><h1>Title</h1><p>Same text on every page.</p></article><footer>f</footer></body></html>"
    rows = [(i, "http://copies.example/", page) for i in range(30)]
    got = templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"Title\n\nSame text on every page."}


def test_pages_without_an_article_keep_their_text(spark):
    article = "<html><body><div class='menu'>m</div><div>Site name</div><article><h1>T{n}</h1><p>Body {n}</p></article><footer>f</footer></body></html>"
    other = "<html><body><div class='menu'>m</div><div>Site name</div><div class='content'><p>Story {n}</p></div><footer>f</footer></body></html>"
    copied = "<html><body><nav>n</nav><div><h1>Same</h1><p>One text</p><pre>code</pre></div><footer>f</footer></body></html>"
    titled = "<html><body><nav>n</nav><div><h2>Site name</h2><p>Own text {n}</p></div><footer>f</footer></body></html>"
    rows = [(i, "http://mixed.example/", (article if i % 10 < 7 else other).format(n=i)) for i in range(40)]
    # Hosts of two pages each, deduced together.
    rows += [(100 + i, f"http://small{i // 2}.example/", (article if i % 10 < 6 else other).format(n=i)) for i in range(40)]
    rows += [(200 + i, "http://copied.example/", copied) for i in range(10)]
    rows += [(300 + i, "http://titled.example/", titled.format(n=i)) for i in range(10)]
    got = {r.page_id: r.text for r in templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for start, shown in ((0, 7), (100, 6)):
        assert all(got[start + i] == (f"T{i}\n\nBody {i}" if i % 10 < shown else f"Story {i}") for i in range(40))
    assert {got[200 + i] for i in range(10)} == {"Same\n\nOne text\n\ncode"}
    assert all(got[300 + i] == f"Own text {i}" for i in range(10))


def test_repeated_pages_have_the_text_of_single_ones(spark):
    # Each of three blocks stands on six of ten pages, not the same ones: by their count alone they would be a class.
    blocks = [("a", range(0, 6), "<a href='x'>link {n}</a>"), ("b", range(2, 8), "longer text of b {n}"), ("c", range(4, 10), "longer text of c {n}")]
    body = lambda n: "".join(f"<div class='{k}'>{inner.format(n=n)}</div>" for k, on, inner in blocks if n in on)
    rows = [(n, "http://twice.example/", f"<html><body><section><p>own {n}</p></section>{body(n)}</body></html>") for n in range(10)]
    once, twice = ({r.page_id: r.text for r in templates.extract(spark.createDataFrame(rows * k, "page_id long, url string, html string")).collect()} for k in (1, 2))
    assert once == twice and "link 0" in twice[0]
