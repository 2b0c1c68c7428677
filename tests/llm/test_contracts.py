"""The registered queries against brute force, on tables with nasty cases."""

import zlib

import pytest
from millrace.llm import packing
from millrace.llm._common import stash
from millrace.llm.queries import QUERIES, vocabulary

from . import brute


def got(spark, sf, name, *cols):
    return sorted(tuple(r[c] for c in cols) for r in QUERIES[name](spark, sf).collect())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


def test_secrets(spark, sf, rows):
    want = sorted((i, *n, s) for i, t in rows for n, s in [brute.secrets(t)])
    assert got(spark, sf, "op2_secrets", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == want
    spans = {r.doc_id: r.spans for r in QUERIES["op2_secrets"](spark, sf).collect()}
    assert any("git_token" in s for s in spans.values())


def test_urls(spark, sf):
    urls = spark.read.parquet(f"{sf}/pages.parquet").collect()
    out = {r.page_id: r for r in QUERIES["op4_url_filter"](spark, sf).collect()}
    assert len(out) == len(urls)
    for r in urls:
        host, path, rule, verdict = brute.url(r.url)
        o = out[r.page_id]
        assert (o.host, o.path, o.rule) == (host, path, rule), r.url
        assert o.verdict == (verdict or ("allow" if o.mined is None else "block"))


def test_mined_rules(spark):
    """Rules and verdicts against all token combinations, tried one by one."""
    import random
    from collections import Counter
    from itertools import combinations

    from millrace.llm import url_filter

    draw, rows = random.Random(8), []
    for i in range(600):
        host, lang, word = draw.choice(["a.farm.org", "b.farm.org", "good.org", "m.good.org"]), draw.choice(["en", "de"]), draw.choice(["casino24", "news-7", "about"])
        key = draw.choice(["", "?win=1", "?page=2"])
        bad = (host.endswith("farm.org") and word == "casino24") or (key == "?win=1" and lang == "de" and host == "good.org" and word == "news-7") or draw.random() < 0.01
        rows.append((i, f"http://{host}/{lang}/{word}/{i}{key}", bad))
    sample = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    rules = url_filter.mine(sample, support=0.01, confidence=0.9, least_rows=6)

    def tokens(u):
        host, path = brute.url(u)[:2]
        labels = host.split(".")
        out = {"scheme=http"} | {"host=" + ".".join(labels[k:]) for k in range(len(labels))} | {f"label={x}" for x in labels if x not in ("com", "net", "org", "www")}
        return frozenset(out | {f"path={x}" for x in brute.re.findall(r"[^\W\d_]+", path)} | {f"key={x}" for x in brute.re.findall(r"[?&]([a-z]+)=", u)})

    seen, hits = Counter(), Counter()
    for _, u, bad in rows:
        t = sorted(tokens(u))
        for n in range(1, len(t) + 1):
            for c in combinations(t, n):
                seen[c] += 1
                hits[c] += bad
    found = {frozenset(c): hits[c] / seen[c] for c in seen if hits[c] >= 6 and hits[c] >= 0.9 * seen[c]}
    want = {c for c, conf in found.items() if not any(d < c and found[d] >= conf for d in found)}
    assert {frozenset(r.tokens) for r in rules.collect()} == want and any(len(c) > 3 for c in found)
    out = {r.page_id: (r.verdict, r.mined) for r in url_filter.judge(sample, rules, []).collect()}
    for i, u, _ in rows:
        fits = any(c <= tokens(u) for c in want)
        assert out[i][0] == ("block" if fits else "allow") and (out[i][1] is not None) == fits


def test_labelled_urls(spark):
    """A fixed rule's word goes before the labels'; URLs with neither are left out."""
    from millrace.llm import url_filter

    pages = spark.createDataFrame([(1, "http://a.com/"), (2, "http://a.net/es/"), (3, "http://a.org/"), (4, "http://a.org/"), (None, "x"), (5, None)], "page_id long, url string")
    labels = spark.createDataFrame([(1, 0, 0), (3, 0, 0), (5, 1, 1), (None, 0, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    out = url_filter.labelled(pages, labels, [("allow", "com", "/"), ("block", "net", "/es/")]).collect()
    assert sorted((r.page_id, r.bad) for r in out) == [(1, False), (2, True), (3, True), (5, True)]


def test_exact(spark, sf, rows):
    assert got(spark, sf, "op7_exact_dedup", "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute.copies(rows)


def test_packing(spark, sf, rows):
    from tokenizers import Tokenizer

    want = brute.token_pieces(rows, Tokenizer.from_file(vocabulary()))
    out = QUERIES["op8_packing"](spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in out)
    assert len(bins) <= -(-total // 4096) + 2


@pytest.mark.parametrize("name,by_chunk", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_ids_of_any_vocabulary(spark, rows, name, by_chunk):
    """A vocabulary that keeps case and white space goes through the whole tokenizer; ids are the library's either way."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary(name))
    cache = packing.ChunkIds(vocabulary(name))
    assert cache.by_chunk == by_chunk
    for _, text in rows:
        want = whole.encode(text or "", add_special_tokens=False).ids
        assert packing.token_bytes((text or "").encode(), cache, None) == b"".join(i.to_bytes(4, "little") for i in want)
    docs = spark.createDataFrame(rows[:40], "doc_id long, text string")
    out = packing.pack_documents(docs, vocabulary(name)).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in out} == {i: len(whole.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in rows[:40]}


def test_open_bins_are_bounded_and_fullest_closes_first():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # the bin with 7 closed
    assert bins.open == 2
    assert bins.put(2) == (2, 8)  # the fullest that takes it
    assert bins.put(4) == (0, 6)
    assert bins.open == 0


def test_quality(spark, sf, rows):
    want = sorted((i, *brute.quality(t)) for i, t in rows)
    out = QUERIES["op9_quality_rules"](spark, sf)
    assert sorted(tuple(r)[:7] for r in out.drop("kept", "rule").collect()) == want


def test_learned_list(spark):
    """The list that is learned, and its verdicts, against a plain learner over plainly counted statistics."""
    import random

    from millrace.llm import quality_rules

    draw, docs, labels = random.Random(4), [], []
    for i in range(900):
        n = draw.randint(60, 200)
        words = [f"w{draw.randrange(100_000)}" for _ in range(n)]
        kind = i % 9
        if kind == 0:
            words = [w + "##$" if draw.random() < 0.5 else w for w in words]
        if kind == 1:
            words = [w.upper() for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, 0 if kind < 2 else 1))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rules = quality_rules.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int"))
    stats = {i: brute.features(t) for i, t in docs}
    judged = {r.doc_id: r for r in quality_rules.judge(frame, rules).collect()}

    def verdict(x):
        return next((k for k, r in enumerate(rules) if all(x[f] >= t if up else x[f] <= t for f, up, t in r.tests)), None)

    for i, _ in docs:
        assert judged[i].rule == verdict(stats[i]) and judged[i].kept == (verdict(stats[i]) is None)
    assert [judged[i].kept for i, _ in docs] == [bool(y) for _, y in labels]
    # the first rule's first test has the highest gain of all single thresholds on the growing part
    held = {r.id for r in spark.range(900).selectExpr("id", "pmod(xxhash64(id, 1), 3) = 0 as h").collect() if r.h}
    grow = [(stats[i], y) for i, y in labels if i not in held]
    assert [r.tests for r in rules] == brute.covering(grow, [(stats[i], y) for i, y in labels if i in held])


def test_repeated_words_survive_a_clash_of_hashes(spark):
    """Sorting by the words themselves, which is what a clash falls back to, counts as the hashes do."""
    from millrace.llm import quality_rules
    from pyspark.sql import functions as F

    texts = ["a b c a b c", "a b c d", "x " * 30, "a b c x a b c y a b", " ".join(f"w{i % 7}" for i in range(50)), "a b c b c a c a b a b c"]
    frame = spark.createDataFrame([(t, t.split()) for t in texts], "t string, w array<string>")
    one = frame.select("t", quality_rules.repeated_words(F.col("w")).alias("n"))
    real, F.xxhash64 = F.xxhash64, lambda *c: F.lit(7).cast("long")
    try:
        two = frame.select("t", quality_rules.repeated_words(F.col("w")).alias("n"))
        clashed = {r.t: r.n for r in two.collect()}
    finally:
        F.xxhash64 = real
    assert {r.t: r.n for r in one.collect()} == clashed == {t: brute.quality(t)[4] for t in texts}


def test_near(spark, sf, rows):
    assert got(spark, sf, "op3_minhash", "doc_id", "n_shingles", "component_id", "kept") == brute.near(rows)


def test_near_with_null_and_repeated_ids(spark):
    from millrace.llm import minhash

    a, b = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(59)) + " x"
    docs = spark.createDataFrame([(None, a), (5, a), (5, a), (3, b), (9, None), (None, None), (2, "z")], "doc_id long, text string")
    out = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in minhash.near_groups(docs, percent=80).collect())
    assert out == [(0, 0, True), (0, 3, True), (2, 2, True), (3, 3, True), (5, 3, False), (5, 3, False), (9, 9, True)]


def test_ids_with_several_texts(spark):
    """An id links its texts in groups; in what goes, each row is judged by its own text."""
    from millrace.llm import exact_dedup, minhash

    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    frame = spark.createDataFrame([(3, a, 1), (5, a, 2), (5, b, 3), (4, b, 4)], "doc_id long, text string, _gone long")
    assert sorted((r.doc_id, r.component_id) for r in minhash.near_groups(frame).collect()) == [(3, 3), (4, 3), (5, 3), (5, 3)]
    assert sorted((r.doc_id, r.text) for r in minhash.drop_near(frame).collect()) == [(3, a), (4, b)]
    frame = spark.createDataFrame([(1, "a", 0, "x"), (2, "A", 0, "x"), (2, "b", 0, "x"), (None, "a", 0, "x"), (None, "c", 0, "x")], "doc_id long, text string, _gone int, sha string")
    for drop in (exact_dedup.drop_copies, minhash.drop_near):
        out = drop(frame)
        assert out.columns == frame.columns
    assert sorted((r.doc_id or 0, r.text) for r in exact_dedup.drop_copies(frame).collect()) == [(0, "c"), (1, "a"), (2, "b")]


def test_near_rounds_and_the_exact_rest(spark):
    """Groups that no single hub brings together: chains, and two groups bridged by one pair, in small parts."""
    import random

    from millrace.llm import minhash

    draw, rows = random.Random(11), []
    for g in range(3):
        words = [f"g{g}w{i}" for i in range(150)]
        for step in range(40):
            rows.append((len(rows), " ".join(words)))
            for _ in range(2):
                words[draw.randrange(150)] = f"g{g}s{step}{draw.random()}"
    draw.shuffle(rows)
    frame, minhash.PART = spark.createDataFrame(rows, "doc_id long, text string"), 7
    try:
        for k, percent in ((5, 80), (3, 85)):
            assert sorted(tuple(r) for r in minhash.near_groups(frame, k=k, percent=percent).collect()) == brute.near(rows, k, percent)
    finally:
        minhash.PART = 2000


def test_components(spark):
    import random

    from millrace.llm.components import components, merged

    draw = random.Random(2)
    links = [(i, i + 1) for i in range(300) if i % 97] + [(1000, 1000 + i) for i in range(1, 200)] + [(draw.randrange(2000, 2300), draw.randrange(2000, 2300)) for _ in range(160)] + [(7, 7)]
    def brute_labels(pairs):
        label = {x: x for p in pairs for x in p if p[0] != p[1]}
        while True:
            last = dict(label)
            for a, b in pairs:
                if a != b:
                    label[a] = label[b] = min(label[a], label[b])
            if label == last:
                return label
    frame = lambda x: spark.createDataFrame(x, "a long, b long")
    labels = components(frame(links))
    assert {r.node: r.label for r in labels.collect()} == brute_labels(links)
    more = [(50, 1100), (2000, 5000), (6000, 6001), (98, 1)]
    assert {r.node: r.label for r in merged(labels, frame(more)).collect()} == brute_labels(links + more)
    assert components(frame([])).collect() == []


def test_bands_miss_less_than_promised():
    from millrace.llm import minhash

    for t in (0.8, 0.85, 0.9):
        r = minhash.band_rows(t)
        assert (1 - t**r) ** (2 * minhash.PERMUTATIONS // r) <= minhash.MISS


def test_min_max_values_are_unbiased():
    import numpy as np
    from millrace.llm import minhash

    draw, minmax, same = np.random.default_rng(3), minhash.MinMax(), []
    for _ in range(60):
        both, one, two = (draw.integers(0, 1 << 63, n, np.uint64) for n in (800, 100, 100))
        x, y = (minmax.signature(np.concatenate([both, z])) for z in (one, two))
        same.append((x == y).mean())
    assert abs(np.mean(same) - 0.8) < 0.02


def test_repeats(spark, sf, rows):
    assert got(spark, sf, "op6_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == brute.repeats(rows)


def test_repeats_with_null_and_repeated_ids(spark):
    from millrace.llm import substring_dedup

    p = " ".join(f"p{i}" for i in range(40))
    docs = [(None, p + " a"), (None, "b " + p), (4, "c"), (4, None), (7, "q " * 70), (8, " ".join(f"n{i}" for i in range(80)))]
    out = substring_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in out) == [(0, 41, 40), (0, 41, 40), (4, 0, 0), (4, 1, 0), (7, 70, 70), (8, 80, 0)]


def test_fm_index_counts_as_brute_force():
    import numpy as np
    from millrace.llm.fm_index import FMIndex

    draw = np.random.default_rng(5)
    text = draw.integers(1, 4, 400)
    text[[99, 250, 399]] = 0
    index, ends = FMIndex(text, 12), np.arange(1, 400)
    joined = text.tolist()

    def longest(end):
        best = 0
        for n in range(1, 13):
            p = joined[max(0, end - n) : end]
            if len(p) < n or 0 in p or sum(joined[i : i + n] == p for i in range(len(joined) - n + 1)) < 2:
                break
            best = n
        return best

    assert index.matching_statistics(text, ends, 12).tolist() == [longest(e) for e in ends.tolist()]


def test_personal_data(spark, sf, rows):
    want = sorted((i, *n, s) for i, t in rows for n, s in [brute.personal(t)])
    assert got(spark, sf, "op5_personal_data", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == want


def test_terms_that_disclose(spark):
    from millrace.llm import pii
    from pyspark.sql import functions as F

    docs = [(i, f"w{i} v{i % 50}\nfoo x{i} Reach us: a{i}@b{i}.org, or not y{i}\nthe end of it {'or not ' * 3}") for i in range(200)]
    docs += [(200 + i, f"or not the n{i} " * 30) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = pii.find_personal(frame)
    both = found.join(frame, "doc_id").select("doc_id", "text", "spans", pii.sanitised(F.col("text"), F.col("spans")).alias("clean")).orderBy("doc_id").collect()
    for r in both:
        assert [r.text[s.start : s.end] for s in r.spans] == ([f"a{r.doc_id}@b{r.doc_id}.org", "foo", "Reach", "us"] if r.doc_id < 200 else [])
    assert both[3].clean == "w3 v3\n x3  : <email>, or not y3\nthe end of it or not or not or not "


def test_terms_that_disclose_survive_copies(spark):
    """A term that stands beside e-mails alone scores 1, however often its documents are copied or two e-mails share it."""
    from millrace.llm import pii

    texts = [f"write to clerk{k} zorblat now u{k}@mail.org or v{k}@mail.org" for k in range(pii.SUPPORT)] * 50 + ["plain words of no account " * 40] * 20
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = stash(pii.entities(frame), "entities")
    score = {(r.term, r.kind): r.score for r in pii.disclosing_terms(frame, found).collect()}
    assert abs(score["zorblat", "email"] - 1) < 1e-9


def test_terms_that_disclose_are_found_in_whole_texts(spark):
    """On other lines, far from the entity and in texts without one; a word inside an entity is no term."""
    from millrace.llm import pii

    far = " ".join(f"far{i}" for i in range(20))
    texts = [f"n{k} zorblat u{k}@mail.org" for k in range(60)] + [f"zorblat, {far}\n \tZorblat! x@mail.org {far} zorblat", "🙂  zorblat", "nothing here", None] + ["plain words of no account " * 40] * 20
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == "term"] for r in pii.find_personal(frame).collect()}
    assert rows[60] == ["zorblat", "Zorblat", "zorblat"] and rows[61] == ["zorblat"]
    assert rows[0] == ["zorblat"] and rows[62] == rows[63] == []


def test_contexts_are_bounded_by_words(spark):
    """Eight words on each side whole, however long they are."""
    from millrace.llm import pii

    long = ["u" * 500 + str(k) for k in range(10)]
    text = "up\n" + " ".join(long) + " \t a@b.org  " + " ".join(long) + "\ndown"
    frame = spark.createDataFrame([(1, text), (2, "a@b.org"), (3, "x a@b.org\ny")], "doc_id long, text string")
    rows = {r.doc_id: r.contexts[0].words for r in pii.entities(frame).collect()}
    assert [w.term for w in rows[1]] == long[2:] + long[:8]
    assert all(text[w.start : w.end] == w.term for w in rows[1])
    assert rows[2] == [] and [w.term for w in rows[3]] == ["x"]


def test_chunk_cache_is_bounded_as_a_whole(monkeypatch):
    """Chunks, their letters and both generations together; ids stay the library's while entries come and go."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "CACHE", 50)
    whole, cache = Tokenizer.from_file(vocabulary()), packing.ChunkIds(vocabulary())
    for k in range(400):
        text = " ".join("".join(chr(97 + (k * 7 + j * j) % 26) for j in range(n)) + tail for n, tail in ((3 + k % 5, ","), (4, ""), (5 + k % 3, "!?"))) + f" Word{chr(97 + k % 26)}. ȺB{chr(65 + k % 26)}; x{k}"
        assert packing.token_bytes(text.encode(), cache, None) == packing.ChunkIds.pack(whole.encode(text, add_special_tokens=False).ids)
        held = [x for x in (*vars(cache).values(), cache) if isinstance(x, dict) and x is not cache.tails]
        assert sum(len(x) + len(getattr(x, "old", ())) * (x is not cache) for x in held) <= 2 * 50


def test_new_words_are_encoded_many_in_a_call():
    """A text of 1,000 new words, each in four forms, costs a few calls of the library and one entry a word."""
    from tokenizers import Tokenizer

    class Counted:
        def __init__(self, inner):
            self.inner, self.calls = inner, 0

        def encode(self, *args, **kw):
            self.calls += 1
            return self.inner.encode(*args, **kw)

    words = ["".join(chr(97 + (k * 31 + j * j * 7) % 26) for j in range(6)) + chr(97 + k // 40) + chr(97 + k % 26) for k in range(1000)]
    distinct = set(words)
    text = " ".join(f"{w} {w.capitalize()} {w.upper()}, {w}." for w in words)
    whole, cache = Tokenizer.from_file(vocabulary()), packing.ChunkIds(vocabulary())
    cache.bare, cache.whole = bare, full = Counted(cache.bare), Counted(cache.whole)
    assert packing.token_bytes(text.encode(), cache, None) == packing.ChunkIds.pack(whole.encode(text, add_special_tokens=False).ids)
    assert len(distinct) > 500 and bare.calls + full.calls <= 20 and len(cache) == len(distinct)


def test_ids_of_single_letters_and_odd_texts(spark):
    """Every letter that is lower-cased before the library sees it, what lies beside them, and pieces cut anywhere."""
    from tokenizers import Tokenizer

    whole, cache = Tokenizer.from_file(vocabulary()), packing.ChunkIds(vocabulary())
    chars = [chr(c) for c in range(0x21, 0x400)]
    texts = [" ".join(f"{c} a{c} {c}B, A{c}! x{c}\u0331" for c in chars), "", " \x0b\n ", "H\u0331 I\u0307 e\u0301!", "a<|endoftext|>b <|ENDOFTEXT|>", "don't I'LL 's", "x\u00a0y\u2003Z\x1fq\x85", "ΣΑΣ. ẞß İi ǅ", "日本, 語!? 1234 3.5%", "-- ,.;! a-b (c)", "w" * 700 + "É" * 90 + "; end"]
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    for text, ids in zip(texts, want):
        assert packing.token_bytes(text.encode(), cache, None) == packing.ChunkIds.pack(ids), text[:40]
    for size in (1, 3, 7):
        docs = spark.createDataFrame([*enumerate(texts), (99, None)], "doc_id long, text string")
        out = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packing.pieces(docs, vocabulary(), size).collect())
        full = [(k, [*ids, packing.END_ID]) for k, ids in [*enumerate(want), (99, [])]]
        assert out == [(k, j, at, len(ids[at : at + size]), zlib.crc32(packing.ChunkIds.pack(ids[at : at + size]))) for k, ids in full for j, at in enumerate(range(0, len(ids), size))]


@pytest.mark.parametrize("most", [1, 5, 6, 100])
def test_runs_of_texts_hold_all_texts_in_order(most):
    import pyarrow as pa

    texts = ["", "aaa", "bb", "", "cccccccc", "d", "é", ""]
    runs = list(packing.runs(pa.array(texts, pa.large_string()), most))
    assert [t for r in runs for t in r.to_pylist()] == texts
    assert all(len(r) == 1 or sum(len(t.encode()) for t in r.to_pylist()) <= most for r in runs)


def test_a_worker_keeps_no_words_of_packing_when_the_task_is_over(spark):
    """Workers are used again by other operators; only the vocabulary stays with them."""
    import pyarrow as pa

    path = vocabulary()

    def entries(batches):
        for _ in batches:
            pass
        cache = packing.chunk_ids(path)
        yield pa.RecordBatch.from_arrays([pa.array([len(cache) + len(cache.old)])], names=["n"])

    docs = spark.range(2000).selectExpr("id as doc_id", "concat('word', translate(id, '0123456789', 'abcdefghij')) as text")
    assert packing.pieces(docs, path).count() == 2000
    assert {r.n for r in spark.range(100).repartition(8).mapInArrow(entries, "n long").collect()} == {0}


def test_a_shard_of_secrets_takes_little_memory():
    """The trigrams' table and the index over 12 MB of texts; postings and spans are those of plain search."""
    import random
    import tracemalloc

    from millrace.llm import secrets

    rules, draw = secrets.BASE + secrets.MORE, random.Random(5)
    parts = ["Token: abcdef12", "AKIA" + "Q7" * 10, "passWORD='hunter22'", "eyJabc", "xoxb-1234567890ab", "secre", "tokens", "é", "\x00key", "0123456789abcdef" * 2]
    texts = [" ".join(draw.choice(parts) if draw.random() < 0.3 else "lorem ipsum" for _ in range(k % 9)).encode() for k in range(300)]
    postings = (s := secrets.Scanner(rules)).index(texts)
    assert set(postings) == set(s.grams) and all(docs.tolist() == [k for k, t in enumerate(texts) if g in t.lower()] for g, docs in postings.items())
    large = [t * (40_000 // max(1, len(t))) for t in texts]
    tracemalloc.start()
    found = secrets.Scanner(rules).scan(large)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, large)) > 8_000_000 and peak < 32 << 20
    plain = [sorted((m.start(), k, m.end()) for k, (r, regex, _) in enumerate(s.rules) for m in regex.finditer(t.decode()) if r.test(m)) for t in large[:40]]
    assert found[:40] == plain
