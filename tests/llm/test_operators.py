"""Small tables with nulls, empty texts, ties, repeats and clashing columns, against brute force."""

import hashlib
import math
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from coursewise.llm.common import hash_sample, spread_join
from coursewise.llm import bpe, byte_cnn, html_tree, language_id, mixing, pii, quality_rules, simhash, topk, url_filters

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, key string"
EN, DE = "the cat and the dog ran to the house of them ", "der hund und die katze sind nicht auf dem haus "
JUNK = "spam### buy$$$ now*** "
TEXTS = [
    (1, EN * 8, "en"), (2, DE * 8, "de"), (3, None, "en"), (4, "", "de"), (5, "123 !!", None), (6, JUNK * 30, "en"),
    (7, EN * 8, "en"), (7, EN * 8, "en"), (8, EN * 7 + "the bird flew", "en"), (None, EN * 3, None), (9, EN * 3000, "en"),
    (10, "mail a.b@c-d.org, +1 (771) 555-1655, 10.0.0.256 1.2.3.4 card 4111 1111 1111 1111 x", "en"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, g, None if i == 3 else f"s{(i or 0) % 3}", 1, 2, 3.0, "k") for i, t, g in TEXTS]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i != 6), 0) for i in (1, 2, 6, 7, 8, 9)] + [(6, 0, 0), (None, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def source():
    return bpe.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def test_empty_tables(spark, docs, labels, source):
    none, no_labels = docs.limit(0), labels.limit(0)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for out in (
        byte_cnn.quality_scores(none, no_labels), bpe.token_table(none, source), quality_rules.quality_table(none, no_labels),
        simhash.near_duplicates(none), simhash.keep_one(none), mixing.mix_table(none), mixing.mix_documents(none), pii.pii_table(none),
        pii.redact_documents(none), language_id.language_table(none), html_tree.extract(pages),
        url_filters.judge_urls(pages, pages.select(F.col("url").alias("key"))), topk.top_k(vectors, F.col("vec_id") % 100 == 0),
    ):
        assert out.count() == 0


def test_quality_classifier(docs, labels):
    rows = byte_cnn.quality_scores(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows if r.doc_id is not None)
    assert {r.score for r in byte_cnn.quality_scores(docs, labels.limit(0)).collect()} == {0.5}


def test_network_learns_and_covers_the_end():
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    good = [" ".join(word() for _ in range(rng.integers(20, 300))).encode() for _ in range(60)]
    bad = [b" ".join(w + b"$$$" for w in g.split()) for g in good]
    net = byte_cnn.fit_network(good[:40] + bad[:40], np.r_[np.ones(40), np.zeros(40)], epochs=15)
    assert (byte_cnn.probabilities(net, good[40:]) > 0.5).mean() > 0.9
    assert (byte_cnn.probabilities(net, bad[40:]) < 0.5).mean() > 0.9
    alone, together = byte_cnn.probabilities(net, good[:1]), byte_cnn.probabilities(net, good[:3])
    assert alone[0] == pytest.approx(together[0], abs=1e-6)


def test_bpe_keeps_a_bounded_word_table(source, monkeypatch):
    own, asked = bpe.Coder(source), []
    encode = own.encode_words
    monkeypatch.setattr(own, "encode_words", lambda words: asked.append(set(words)) or encode(words))
    monkeypatch.setattr(bpe, "TABLE_WORDS", 3)
    long = "x" * (bpe.LONGEST_KEPT + 1)
    batches = [["a b", long], ["b a c d", "a " + long], ["d e"], ["a"]]
    got = [own.encode_texts(b) for b in batches]
    assert got == [bpe.Coder(source).encode_texts(b) for b in batches]
    # known words aren't encoded again; a long one is, and so is what a full table let go
    assert asked == [{"a", " b", long}, {"b", " a", " c", " d", " " + long}, {"d", " e"}, {"a"}]


def test_bpe_is_the_library(spark, docs, source):
    tok = Tokenizer.from_str(source)
    odd = ["<|endoftext|>a <|endoftext|>", "  x\n\n y", "ǅ՘₏ 漢字 \U0001f600'll", "a" * 3000]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(odd, 100)), "doc_id long, text string"))
    got = sorted(tuple(r) for r in bpe.token_table(table.where("doc_id is not null"), source).collect())
    want = []
    for i, t in [(i, t) for i, t, _ in TEXTS if i is not None] + list(enumerate(odd, 100)):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)
    back = bpe.decode_documents(bpe.encode_documents(table, source), source)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(r.doc_id), r.text or "") for r in table.collect())


def test_known_characters_are_split_alike(source):
    own = bpe.Coder(source)
    for cp in range(0x20, 0xD7A4):
        if own.known(chr(cp)):
            t = f"a{chr(cp)}1 {chr(cp)}\n"
            assert [t[s:e] for _, (s, e) in own.model.pre_tokenizer.pre_tokenize_str(t)] == own.pattern(t)


def test_urls(spark):
    urls = [
        None, "no scheme", "http://A.COM", "http://a.com/x", "https://b.example.com/en/1?q", "https://www.example.com/en/1#t",
        "http://x.net/es/1", "http://x.net/esp", "http://bad.org/a.html", "http://www.bad.org/a/", "http://ok.org/a", "http://bad.org/a",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("key", F.lit("clash"))
    listed = spark.createDataFrame([("bad.org/a",), ("bad.org/a",), (None,)], "key string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.judge_urls(pages, listed).collect()}
    assert got[0] == got[1] == ("", "", None, "allow") and got[2] == ("a.com", "", None, "allow")
    assert got[3][2:] == ("com/", "allow") and got[4] == ("b.example.com", "/en/1", "example.com/en/", "block")
    assert got[5][2:] == ("www.example.com/en/", "allow") and got[6][3] == "block" and got[7][2:] == (None, "allow")
    assert [got[i][3] for i in (8, 9, 10, 11)] == ["block", "block", "allow", "block"]


def test_topk(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(150)] + [(200 + i, [0.5] * 6) for i in range(40)]
    rows += [(300, None), (301, [None] * 6), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, [1.0]), (200, [0.5] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rep", F.lit(0))
    got = [tuple(r) for r in topk.top_k(table, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    vecs = {i: np.floor(1024 * np.array(v, np.float32).astype(float)) for i, v in rows[:190]}
    want = []
    for q in (0, 100, 200):
        best = sorted((-int(v @ vecs[q]), i) for i, v in vecs.items() if i != q)[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == want


def test_topk_of_several_lengths_and_huge_components(spark):
    rng = np.random.default_rng(13)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(150)] + [(1000 + i, rng.normal(size=3).tolist()) for i in range(3)] + [(2000, [1.0] * 7), (2100, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(table, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    vecs = {i: np.floor(1024 * np.array(v)) for i, v in rows}
    want = []
    for q in (0, 100, 1000):
        best = sorted((-int(v @ vecs[q]), i) for i, v in vecs.items() if i != q and len(v) == len(vecs[q]))[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == want
    with pytest.raises(Exception, match="exceed a long"):
        topk.top_k(spark.createDataFrame([(0, [1e12] * 2), (1, [1e12] * 2)], "vec_id long, embedding array<double>"), F.lit(True)).collect()


def test_training_samples_are_bounded(spark):
    one_id = spark.range(50_000).select((F.col("id") % 2).cast("int").alias("label"), F.lit(7).alias("doc_id"), F.lit("same").alias("text"))
    got = hash_sample(one_id, 100, "label").collect()
    assert sorted(r.label for r in got) == [0, 1]  # equal rows are one
    texts = one_id.withColumn("text", F.monotonically_increasing_id().cast("string")).repartition(5)
    got = hash_sample(texts, 100, "label").collect()
    assert [sum(r.label == k for r in got) for k in (0, 1)] == [100, 100]
    assert sorted(got) == sorted(hash_sample(texts.repartition(3), 100, "label").collect())
    assert hash_sample(texts.limit(0), 100, "label").count() == 0


def test_network_against_plain_loops():
    rng = np.random.default_rng(14)
    texts = [rng.integers(32, 127, n).astype(np.uint8).tobytes() for n in (0, 1, 40, 700, 3000)]
    net = byte_cnn.fit_network(texts, np.array([0, 1, 0, 1, 1.0]), epochs=2)
    alone = [float(byte_cnn.probabilities(net, [t])[0]) for t in texts]
    assert alone == pytest.approx(byte_cnn.probabilities(net, texts).tolist(), abs=1e-6)
    forest = quality_rules.fit_forest(rng.random((300, len(quality_rules.FEATURES))), (rng.random(300) < 0.4).astype(float), list(quality_rules.FEATURES.values()))
    x = rng.random((50, len(quality_rules.FEATURES)))

    def walk(row):
        total = forest.base
        for at in forest.roots:
            while forest.left[at] != forest.right[at]:
                at = forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
            total += forest.value[at]
        return 1 / (1 + math.exp(-total))

    assert forest.score(x) == pytest.approx([walk(r) for r in x])


def test_quality_statistics():
    text = "a b c\na b c\nx # a b c\n\n\n q é"
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    got = quality_rules.statistics_of(text.encode())
    assert got[:5] == (len(words), sum(map(len, words)), 1, 1, 9)
    assert quality_rules.statistics_of(b"")[:5] == (0, 0, 0, 0, 0)


def test_quality_rules(docs, labels):
    rows = quality_rules.quality_table(docs, labels).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules.keep_good(docs, labels).columns == docs.columns


def test_trees_are_monotone_and_learn():
    rng = np.random.default_rng(1)
    x = rng.random((800, len(quality_rules.FEATURES)))
    y = (x[:, 2] + 0.3 * rng.random(800) < 0.6).astype(float)
    forest = quality_rules.fit_forest(x, y, list(quality_rules.FEATURES.values()))
    assert ((forest.score(x) >= 0.5) == y).mean() > 0.9
    for f, sign in enumerate(quality_rules.FEATURES.values()):
        if sign:
            grid = np.repeat(x[:20], 50, 0)
            grid[:, f] = np.tile(np.linspace(0, 1, 50), 20)
            assert (sign * np.diff(forest.score(grid).reshape(20, 50), axis=1) >= -1e-12).all()


def test_spread_join(spark):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 500 + list(range(2, 400)) + [7] * 3 + [None])], "k long, i long")
    table = spark.createDataFrame([(k, f"v{k}", 500 if k == 1 else 4 if k == 7 else 1) for k in range(1, 400)], "k long, v string, n long")
    for shares in (1, 10, 1000):
        got = sorted(map(tuple, spread_join(rows, table, "k", shares).select("k", "i", "v").collect()))
        assert got == sorted((r.k, r.i, f"v{r.k}") for r in rows.collect() if r.k is not None)
    assert spread_join(rows.limit(0), table.limit(0), "k").count() == 0


def brute_print(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash(docs):
    rows = simhash.near_duplicates(docs).collect()
    prints = {(i, t): brute_print(t) for i, t, _ in TEXTS}
    assert sorted(f"{p:016x}" for (i, t) in [(a, b) for a, b, _ in TEXTS] for p in [prints[i, t]]) == sorted(r.fingerprint for r in rows)
    by = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert by[7] == 1 and by[3] == by[4] == 3 and len(rows) == len(TEXTS)
    clashing = simhash.near_duplicates(docs.withColumn("row_id", F.lit("clash")).withColumn("n", F.lit("x"))).collect()
    assert sorted(map(str, clashing)) == sorted(map(str, rows))
    kept = simhash.keep_one(docs.withColumn("row_id", F.lit("clash"))).drop("row_id")
    assert kept.columns == docs.columns and kept.count() == len({r.component_id for r in rows})


def near_prints(rng, n, kin):
    """Random fingerprints, and near ones of ``kin`` of them with bits changed in one part, in several, or one in each."""
    values = list(rng.integers(0, 2**63, n, dtype=np.uint64))
    for b in values[:kin]:
        for k in (1, 2, 3, 4, 4, 5):
            values.append(b ^ np.uint64(sum(1 << int(i) for i in rng.choice(64, k, replace=False))))
        values.append(b ^ np.uint64(sum(1 << int(16 * p + rng.integers(16)) for p in range(4))))
        values.append(b ^ np.uint64(sum(1 << int(i) for i in rng.choice(16, 4, replace=False))))
    return np.unique(np.array(values, np.uint64))


def test_every_link_meets_in_a_lower_shard_and_copies_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 1)
    monkeypatch.setattr(simhash, "DEEP", 0)  # trees below every shard
    copies = []
    for n in (200, 4000):
        bits = near_prints(np.random.default_rng(n), n, 40)
        frame = spark.createDataFrame([(int(x),) for x in bits.view(np.int64)], "bits long")
        upper = simhash.routed(frame)
        lower = simhash.routed_below(upper)
        assert upper.count() <= (4 + 16) * len(bits)
        copies.append(lower.count() / len(bits))
        rows = {}
        for r in lower.collect():
            rows.setdefault((r.tree, r.shard, r.below), []).append((r.bits & 2**64 - 1, r.guest))
        met = {frozenset((a, b)) for own in rows.values() if len(own) < 400 for a, ga in own if not ga for b, _ in own if a != b}
        i, j = np.nonzero(np.triu(np.bitwise_count(bits[:, None] ^ bits[None]) <= 4, 1))
        assert len(i) > 200 and all(frozenset((int(bits[x]), int(bits[y]))) in met for x, y in zip(i, j, strict=True))
    assert max(copies) <= 4 * (3 + 2 * 16) + 16 * 17 and abs(copies[0] - copies[1]) < 0.2 * copies[0]


@pytest.mark.parametrize(("block", "deep"), ((4096, 16), (3, 16), (3, 0), (1, 2)))
def test_simhash_links_all_components(spark, monkeypatch, block, deep):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "DEEP", deep)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    values = list(base)
    for b in base[:100]:
        for n in (1, 4, 4, 5):
            values.append(b ^ np.uint64(sum(1 << int(i) for i in rng.choice(64, n, replace=False))))
    values += [base[0] ^ np.uint64(1 | 1 << 16 | 1 << 32 | 1 << 48)]
    bits = np.unique(np.array(values, np.uint64))
    root = list(range(len(bits)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in zip(*np.nonzero(np.bitwise_count(bits[:, None] ^ bits[None]) <= 4), strict=True):
        root[find(i)] = find(j)
    frame = spark.createDataFrame([(int(x),) for x in bits.view(np.int64)], "bits long")
    got = {r.bits: r.root for r in simhash.component_of(frame).collect()}
    groups = lambda key: {frozenset(i for i in range(len(bits)) if key(i) == k) for k in {key(i) for i in range(len(bits))}}
    signed = bits.view(np.int64).tolist()
    assert groups(find) == groups(lambda i: got[signed[i]])


def test_mixing(spark):
    rows = [(i, "w " * (1 + i % 7), None if i % 5 == 4 else f"s{i % 5}") for i in range(400)] + [(None, "w", "s0"), (9, None, "s4")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("target", F.lit(1))
    out = mixing.mix_table(docs).collect()
    assert len(out) == len(rows) and sorted(map(str, out)) == sorted(map(str, mixing.mix_table(docs.repartition(7)).collect()))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    targets, budget = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in targets]
        share = {s: (budget - sum(targets.values())) * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        targets |= {s: 2.0 * sizes[s] for s in over}
        if not over:
            targets |= share
            break
    assert sorted({r.target for r in out}) == pytest.approx(sorted(set(targets.values())))
    assert all(r.taken <= 2 * r.size for r in out)
    assert abs(sum(r.taken for r in out) - sum(targets.values())) <= 7 * len(targets)
    copies = mixing.mix_documents(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r.taken // r.size for r in out if r.size)


def plain_mix(rows, targets, sizes, seed=7):
    """Copies of rows (doc_id, size, source) in plain Python: whole repetitions, then a pass in the order of draws."""
    copies = [0] * len(rows)
    for source, target in targets.items():
        whole = min(int(target // sizes[source]), 2) if sizes[source] else 0
        due = target - whole * sizes[source]
        draw = lambda i: (hashlib.md5(f"{seed}:{'' if rows[i][0] is None else rows[i][0]}:{rows[i][1]}".encode()).hexdigest(), i)
        own = sorted((i for i, r in enumerate(rows) if r[2] == source and r[1]), key=draw)
        room, left = math.floor(due), []
        for i in own:
            copies[i] = whole
            if rows[i][1] <= room:
                room -= rows[i][1]
                copies[i] += 1
            else:
                left.append(i)
        missing = room + due - math.floor(due)
        best = min(left, key=lambda i: (rows[i][1], draw(i)), default=None)
        if best is not None and rows[best][1] < 2 * missing:
            copies[best] = min(copies[best] + 1, 2)
    return copies


@pytest.mark.parametrize("percent", (37, 117, 150))
def test_mixing_reaches_what_is_reachable(spark, percent):
    rng = np.random.default_rng(percent)
    rows = [(i, 1, "giant") for i in range(300)] + [(999, 300, "giant")]  # a document as large as the rest
    rows += [(5, 4, None)] * 50 + [(6, 3, None)] * 30 + [(None, 2, None)] * 2  # repeated ids
    rows += [(2000 + i, int(n), "mixed") for i, n in enumerate(rng.geometric(0.02, 150))] + [(3000, 0, "empty")]
    docs = spark.createDataFrame([(i, "w " * n, s) for i, n, s in rows], "doc_id long, text string, source string").withColumn("room", F.lit("clash"))
    out = mixing.mix_table(docs.repartition(5), share_percent=percent).collect()
    sizes = {}
    for _, n, s in rows:
        sizes[s] = sizes.get(s, 0) + n
    of_size = {r.source_size: r.target for r in out}
    targets = {s: of_size[n] for s, n in sizes.items()}
    copies = plain_mix(rows, targets, sizes)
    want = sorted((i or -1, n, n * c) for (i, n, _), c in zip(rows, copies, strict=True))
    assert sorted((r.doc_id or -1, r.size, r.taken) for r in out) == want
    for s in ("giant", None):  # within half of the smallest document
        taken = sum(r.taken for r in out if r.source_size == sizes[s])
        assert abs(taken - targets[s]) <= 1.5
    mixed = mixing.mix_documents(docs, share_percent=percent)
    assert mixed.columns == docs.columns and mixed.count() == sum(copies)


def test_html(spark):
    html = (
        "<html><head><title>t</title></head><body><nav>menu</nav><div class='cookie-notice'>c</div><article><header><h1>Big &amp; "
        "small</h1></header><p>one <b>two</b><br>three<p>four\n\n five<script>var x='</p>';</script><ul><li>a<li>b</ul>"
        "<section id='comments'>no</section><form>f</form></article><aside>s</aside><footer>end</footer></body></html>"
    )
    rows = [(1, "http://h/1", html), (2, None, None), (3, "http://h/2", ""), (1, "http://h/1", html), (4, "http://i/", "<div>plain<p>text")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = sorted((r.page_id, r.text, r.n_chars) for r in html_tree.extract(pages).collect())
    text = "Big & small\n\none two three\n\nfour five\n\na\n\nb"
    assert got == [(1, text, len(text))] * 2 + [(2, "", 0), (3, "", 0), (4, "plain\n\ntext", 11)]


def test_site_style_tree_drops_what_repeats(spark):
    page = "<body><div class='strap'>Same on all pages</div><div class='story'><p>Story {0} {1}</p></div></body>"
    rows = [(i, f"http://h/{i}", page.format(i, "x" * i)) for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_tree.extract(pages).collect()} == {i: f"Story {i} {'x' * i}".strip() for i in range(12)}


def test_copies_of_a_page_are_no_boilerplate(spark):
    page = "<body><div class='story'><p>Story {0}</p></div></body>"
    rows = [(i, f"http://h/1?q={i}", page.format("one")) for i in range(30)] + [(30 + i, f"http://h/{i}", page.format(i)) for i in range(5)]
    cells = "<article><table><tr>" + "<td>7</td>" * 20 + "<td>{0}</td></tr></table><div>7</div>" + "<div>7</div>" * 5 + "</article>"
    rows += [(50, "http://one/", cells.format(1))] + [(60 + i, f"http://many/{i}", cells.format(i)) for i in range(10, 16)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_tree.extract(pages).collect()}
    assert [got[i] for i in range(35)] == ["Story one"] * 30 + [f"Story {i}" for i in range(5)]
    assert got[50].split() == ["7"] * 20 + ["1"] + ["7"] * 6
    assert [got[60 + i].split().count(str(i)) for i in range(10, 16)] == [1] * 6


def test_names_alone_drop_no_content(spark):
    wrapped = "<body><div {0}><article><h1>A</h1><div class='share-price'>B</div></article></div></body>"
    names = ["id='content' class='has-sidebar'", "class='no-ads'", "class='related-layout'", "class='sidebar'"]
    rows = [(i, f"http://s{i}/", wrapped.format(n)) for i, n in enumerate(names)]
    page = "<article><h1>T{0}</h1><p class='notice'>Notice {0}</p><div class='ad'>Buy <p>this</p></div></article>"
    rows += [(10 + i, f"http://h/{i}", page.format(i)) for i in range(6)] + [(20, "http://few/", page.format(20))]
    got = {r.page_id: r.text for r in html_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {i: "A\n\nB" for i in range(4)} | {10 + i: f"T{i}" for i in range(6)} | {20: "T20"}  # notices and adverts are no main text
    assert got == want


def test_pii(docs):
    rows = {r.doc_id: r for r in pii.pii_table(docs).collect()}
    text = next(t for i, t, _ in TEXTS if i == 10)
    r = rows[10]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    at = lambda kind, s: f"{kind}:{text.index(s)}:{text.index(s) + len(s)}"
    base = [at("email", "a.b@c-d.org"), at("phone", "+1 (771) 555-1655"), at("ip", "1.2.3.4"), at("card", "4111 1111 1111 1111")]
    assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest() and r.spans.split(",") == base
    assert rows[3].spans == rows[4].spans == "" and rows[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = {r.doc_id: r for r in pii.redact_documents(docs).collect()}
    assert clean[10].text == "mail [EMAIL], [PHONE], 10.0.0.256 [IP] card [CARD] x" and clean[10].n_chars == len(clean[10].text)
    assert clean[3].text is None and clean[1].text == EN * 8


def test_pii_addresses_with_zero_parts(spark):
    text = "10.0.0.1, 192.168.0.1, 0.0.0.0, 001.2.3.4 10.00.1.2 8.8.8.8 but 10.0.0.256 0.0.0.0256 1.2.3.1000"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    held = [m.span() for m in re.finditer(r"[0-9]+(?:\.[0-9]+){3}", text) if all(int(p) <= 255 for p in m.group().split("."))]
    base = ",".join(f"ip:{s}:{e}" for s, e in held)
    [row] = pii.pii_table(docs).collect()
    assert (row.n_ip, row.spans) == (6, base) and row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert pii.redact_documents(docs).first().text == "[IP], [IP], [IP], [IP] [IP] [IP] but 10.0.0.256 0.0.0.0256 1.2.3.1000"


def test_pii_long_credentials(spark):
    rng = np.random.default_rng(4)
    key = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    texts = {
        1: ("use token={} now", f"{key(20)}.e{key(30)}.{key(43)}"), 2: ("my api_key: {}, ok", key(500)), 3: ("secret={}. Then", f"{key(42)}=="),
        4: ("a password = {}\n", f"{key(9)}==.{key(30)}-_"), 5: ("token: {}... no", key(40)), 6: ("the secret={}", "aB3_" * 5000),
    }
    who = ("write to {} please", f"{'long.name' * 10} (at) mail.example.{'c' * 70}")
    docs = [(i, t.format(x)) for i, (t, x) in texts.items()] + [(7, who[0].format(who[1])), (8, "secret=" + "A" * 20_000)]
    out = {r.doc_id: r.text for r in pii.redact_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = {i: re.sub(r"\w+ ?[=:] ?\{\}", "[SECRET]", t) for i, (t, _) in texts.items()}
    assert {i: out[i] for i in texts} == want and out[7] == who[0].format("[EMAIL]")


def test_votes_become_reliabilities():
    posterior = pii.estimate({"11-1": 50, "00-0": 50, "10-1": 3, "----": 10})
    assert posterior["11-1"] > 0.9 and posterior["00-0"] < 0.1


def test_language(docs):
    rows = {r.doc_id: r for r in language_id.language_table(docs).collect()}
    assert rows[1].lang_pred == "en" and rows[2].lang_pred in ("de", "en") and rows[9].lang_pred == "en"
    assert rows[3].lang_pred == rows[4].lang_pred == rows[5].lang_pred == "und"
    profiles = {"en": {g: i for i, g in enumerate(language_id.profile_of(language_id.gram_counts(language_id.letter_words(EN))))}}
    profiles["de"] = {g: i for i, g in enumerate(language_id.profile_of(language_id.gram_counts(language_id.letter_words(DE))))}
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict_languages(docs, profiles).collect()}
    for i, text, _ in TEXTS:
        own = language_id.profile_of(language_id.gram_counts(language_id.letter_words(text or "")))
        if own and i is not None:
            far = {k: sum(abs(p[g] - n) if g in p else 400 for n, g in enumerate(own)) for k, p in profiles.items()}
            best = min(sorted(far), key=far.get)
            assert got[i] == (best, pytest.approx(1 - far[best] / (400 * len(own))))


BROKEN = (
    "<![foo[bar]]>", "<![if x]>", "<![CDATA[a<b]]>", "<!doctype", "<!", "<!--", "<!-->", "<!--a--!>", "<?x", "</", "</p", "<a b='", "<a ", "<", "&", "&#", "&#x;", "&amp",
    "<p>", "</p>", "<li>", "</ul>", "<td>", "<article>", "</article>", "<div class='ad'>", "</div>", "<script>", "</script>", "<title>", ">", "x", "\n", "<br/>", "]]>", "-->",
)


def test_broken_markup_raises_no_error():
    rng = np.random.default_rng(6)
    for _ in range(4000):
        html = "".join(rng.choice(BROKEN, rng.integers(1, 25)))
        html_tree.main_text(html_tree.parse(html), set())
        html_tree.judged(html_tree.parse(html))
    text = lambda html: html_tree.main_text(html_tree.parse(html), set())
    assert text("a<![foo[bar]]>b<!--a--!>c<!-->d<!--->e<![CDATA[x>y]]>f<!-- g") == "abcdef"


@pytest.mark.parametrize("unit", ("<div>", "<p><b>", "<li><ul>", "<table><tr><td>", "<a ", "</", "<!", "<!--", "<?", "&", "<span class='x y'>", "<article>", "<p><table><tr><td><hr>"))
def test_100000_unclosed_tags_take_seconds(unit):
    html = "<body>one" + unit * 100_000 + "two</p></span>"
    start = time.perf_counter()
    root = html_tree.parse(html)
    html_tree.judged(root)
    assert html_tree.main_text(root, set()).startswith(("one", "two"))
    assert time.perf_counter() - start < 20


def test_named_branches_go_on_every_site(spark):
    aside = "<div class='comments'>Said {0}<article class='comment'>Reply {0}</article></div><div class='ad'>Buy {0}</div><div id='sidebar'>See {0}</div><p class='cookie-notice'>Cookies {0}</p>"
    plain = f"<body><div class='story'><p>Story {{0}}</p>{aside}</div><div class='has-sidebar no-ads share-price'>Price {{0}}</div>{aside}</body>"
    inside = f"<body>{aside}<article><h1>T{{0}}</h1><p>Story {{0}}</p>{aside}</article><form class='comments'><main>Main {{0}}</main></form></body>"
    rows = [(i, f"http://plain/{i}", plain.format(i)) for i in range(20)] + [(100 + i, f"http://inside/{i}", inside.format(i)) for i in range(20)]
    rows += [(200, "http://few/", plain.format(200)), (300, "http://odd/", "<p>a<![foo[bar]]>b"), (301, "http://odd/2", "<div>" * 30_000 + "deep")]
    got = {r.page_id: r.text for r in html_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    want = {i: f"Story {i}\n\nPrice {i}" for i in [*range(20), 200]} | {100 + i: f"T{i}\n\nStory {i}\n\nMain {i}" for i in range(20)}
    assert got == want | {300: "ab", 301: "deep"}


def test_style_tree_against_plain_counts(spark):
    page = "<body><div class='strap'>Same <b>{1}</b></div><div class='story'><p>Story {0}</p></div><section>{2}</section></body>"
    htmls = [page.format(i, "on all", "x" if i % 2 else "y") for i in range(8)] + [page.format(0, "on all", "y")]
    rows = [(i, "http://h/", h) for i, h in enumerate(htmls)]
    tree = html_tree.importance(html_tree.style_tree(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)))
    got = sorted((r.pages, round(r.importance, 9)) for r in tree.collect())
    share = html_tree.PRESENTATION_SHARE
    entropy = lambda counts: -sum(c / 8 * math.log(c / 8, 8) for c in counts)
    halves = (1 - share) * entropy([4, 4])
    assert got == sorted((8, round(x, 9)) for x in (0, 1 - share, 1 - share, halves))  # strap, story, story's p, section


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_spans(text):
    """Base spans by kind as the contract states them, with Python's regular expressions."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    digits = lambda v: re.sub("[^0-9]", "", v)
    holds = {
        "email": lambda v: True, "ip": lambda v: all(int(p) <= 255 for p in v.split(".")),
        "card": lambda v: 12 <= len(digits(v)) <= 19 and luhn(digits(v)), "phone": lambda v: 9 <= len(digits(v)) <= 15,
    }
    return {k: [m.span() for m in re.finditer(p, text) if holds[k](m.group())] for k, p in patterns.items()}


def test_pii_base_spans_of_random_texts(spark):
    rng = np.random.default_rng(8)
    atoms = ["a", "Z.", "9", "0", "12", "255", "256", ".", ".", "@", "@b", "-", " ", "+", "+1", "(", ")", "4111 1111", " 1111 1111", "é", "\U0001f600", "x@y.z", "\n", "%", "1.2.3"]
    texts = ["".join(rng.choice(atoms, rng.integers(0, 40))) for _ in range(2500)] + ["4111111111111111 5500-0000-0000-0004 +44 20 7946 0958"]
    rows = pii.pii_table(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()
    found = 0
    for r in rows:
        want = brute_spans(texts[r.doc_id])
        found += sum(map(len, want.values()))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(want[k]) for k in pii.KINDS), texts[r.doc_id]
        ordered = sorted((s, pii.KINDS.index(k), e, k) for k, spans in want.items() for s, e in spans)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in ordered).encode()).hexdigest()
    assert found > 500


def test_pii_many_matches_and_clashing_columns(spark):
    n = 200_000
    texts = {1: "ab 12 " * n, 2: "a 1.2.3.4 " * (n // 2), 3: "é tel 555 123-4567, x@y.org " * (n // 10), 4: "call"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    docs = docs.withColumn("__base", F.lit(1)).withColumn("base", F.lit(2)).withColumn("row", F.lit(3)).withColumn("found", F.lit(4))
    rows = {r.doc_id: r for r in pii.pii_table(docs).collect()}
    assert rows[2].n_ip == n // 2 and rows[1].n_card == 0 and rows[3].n_email == n // 10
    want = brute_spans(texts[2])["ip"]
    assert rows[2].base_sha256 == hashlib.sha256(",".join(f"ip:{s}:{e}" for s, e in want).encode()).hexdigest()
    clean = {r.doc_id: r for r in pii.redact_documents(docs).collect()}
    assert clean[1].text == texts[1] and clean[2].text == "a [IP] " * (n // 2) and clean[4].text == "call"
    assert clean[3].text.count("[EMAIL]") == n // 10 and clean[3].text.count("é") == n // 10 and "@" not in clean[3].text
    assert (clean[1]["__base"], clean[1].base, clean[1]["row"], clean[1].found) == (1, 2, 3, 4)


def test_overlaps_and_redaction_against_plain_python(spark):
    rng = np.random.default_rng(9)
    rows = []
    for _ in range(60):
        text = "".join(rng.choice(list("abé\U0001f600 "), 3000))
        draw = lambda n: sorted((int(s), int(s + rng.integers(1, 6))) for s in rng.integers(0, 2990, n))  # noqa: E731, B023
        rows.append((text, draw(rng.integers(0, 700)), draw(rng.integers(0, 700))))
    kind = "array<struct<start:int,end:int>>"
    frame = spark.createDataFrame(rows, f"text string, base {kind}, found {kind}")
    spans = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit("ip").alias("kind")))
    out = frame.select("*", pii.clear_of(F.col("found"), F.col("base")).alias("clear"), pii.redact(F.col("text"), spans).alias("redacted"))
    for r in out.collect():
        base, found = ([tuple(x) for x in c] for c in (r.base, r.found))
        assert [tuple(x) for x in r.clear] == [(s, e) for s, e in found if not any(s < b and a < e for a, b in base)]
        at, parts = 0, []
        for s, e in base:
            if s >= at:
                parts += [r.text[at:s], "[IP]"]
            at = max(at, e)
        assert r.redacted == "".join(parts) + r.text[at:]
