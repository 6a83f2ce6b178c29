"""The pipeline's stages one after the other against plain Python, on a small fixture."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from coursewise.llm import pii, quality_rules
from tests.llm.test_operators import brute_print, brute_spans, plain_mix

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, row_id string, draw int"


def fixture_rows():
    """Nulls, empty and long texts, exact and near copies, repeated ids, personal data, junk, clashing columns."""
    rng = np.random.default_rng(21)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(600)]
    prose = lambda n: " ".join(rng.choice(vocabulary, n))
    rows = [(i, prose(int(rng.integers(60, 200))), f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, rows[i][1], rows[i][2]) for i in range(8)]  # exact copies
    rows += [(110 + i, prose(1500), "s1") for i in range(2)]
    rows += [(120 + i, rows[68 + i][1] + " end", "s2") for i in range(2)]  # near copies of the long ones
    rows += [(i, rows[i][1], rows[i][2]) for i in (20, 20, 21)]  # repeated rows
    rows += [(130, prose(70) + " mail a.b@c-d.org from 10.0.0.1 or +1 (771) 555-1655, card 4111 1111 1111 1111 " + prose(20), None)]
    rows += [(140 + i, "spam### buy$$$ now*** " * 40, "s0") for i in range(12)] + [(160, None, "s0"), (161, "", None), (162, "short", "s1"), (None, prose(90), "s1")]
    return [(i, t, "en", s, len(t or ""), 5, "clash", 1) for i, t, s in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(fixture_rows(), SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i < 140), 0) for i in [*range(60), *range(140, 152)]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def repeated(words):
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(grams)
    return len({i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)})


def text_key(rows):
    return sorted((str(r[0]), str(r[1]), str(r[3])) for r in rows)


def test_stages_against_plain_python(spark, folder):
    stages = [f for _, f in corpus_pipeline.STAGES]
    docs = corpus_pipeline.table(spark, folder, "documents")
    columns, before = docs.columns, [tuple(r) for r in docs.collect()]

    # quality rules: the base rule by hand, the trees' verdict by document
    judged = {(r.doc_id, r.n_words, r.n_repeat_words): r.kept for r in quality_rules.quality_table(docs, corpus_pipeline.table(spark, folder, "labels")).collect()}
    docs = corpus_pipeline.staged(stages[0](spark, docs, folder), "test")
    kept = [tuple(r) for r in docs.collect()]
    want = []
    for r in before:
        words = re.findall(WORD, r[1] or "")
        verdict = judged[r[0], len(words), repeated(words)]
        assert not (verdict and (len(words) < 50 or 2 * repeated(words) > len(words)))
        want += [r] if verdict else []
    assert docs.columns == columns and text_key(kept) == text_key(want)
    assert {r[0] for r in kept} >= set(range(60)) and not any("###" in r[1] for r in kept)

    # near duplicates: brute-force fingerprints, components by repeated merging, the smallest id stays
    docs = corpus_pipeline.staged(stages[1](spark, docs, folder), "test")
    prints = [brute_print(r[1]) for r in kept]
    group = list(range(len(kept)))
    for _ in kept:
        new = [min(group[j] for j in range(len(kept)) if (prints[i] ^ prints[j]).bit_count() <= 4) for i in range(len(kept))]
        if new == group:
            break
        group = new
    of_group = {}
    for i, r in enumerate(kept):
        of_group.setdefault(group[i], []).append(r)
    single = [min(rows, key=lambda r: (r[0] is None, r[0] or 0)) for rows in of_group.values()]
    kept = [tuple(r) for r in docs.collect()]
    assert docs.columns == columns and text_key(kept) == text_key(single) and len(single) < len(want)

    # personal data: every span goes, the base ones found by hand among them
    spans = {r.doc_id: r.spans for r in pii.pii_table(docs).collect()}
    docs = corpus_pipeline.staged(stages[2](spark, docs, folder), "test")
    clean = []
    for r in kept:
        found = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in spans[r[0]].split(",") if x)]
        assert {(s, e, k) for k, own in brute_spans(r[1]).items() for s, e in own} <= set(found)
        at, parts = 0, []
        for s, e, k in found:
            parts += [r[1][at:s], f"[{k.upper()}]"] if s >= at else []
            at = max(at, e)
        clean.append((r[0], "".join(parts) + r[1][at:], *r[2:]))
    kept = [tuple(r) for r in docs.collect()]
    assert docs.columns == columns and text_key(kept) == text_key(clean) and any("[EMAIL] from [IP] or [PHONE]" in r[1] for r in kept)
    assert all(r[4] == len(r[1]) and r[5:] == (5, "clash", 1) for r in kept)

    # mixing: water-filling and the pass over the draws
    docs = corpus_pipeline.staged(stages[3](spark, docs, folder), "test")
    rows = [(r[0], len(re.findall(WORD, r[1])), r[3]) for r in kept]
    sizes = {}
    for _, n, s in rows:
        sizes[s] = sizes.get(s, 0) + n
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    targets = {}
    while True:
        free = {s: w for s, w in weights.items() if s not in targets}
        left = (150 * sum(sizes.values()) - 100 * sum(targets.values())) / 100
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = {s: 2.0 * sizes[s] for s in free if share[s] > 2 * sizes[s]}
        targets |= over or share
        if not over:
            break
    mixed = [r for r, c in zip(kept, plain_mix(rows, targets, sizes), strict=True) for _ in range(c)]
    kept = [tuple(r) for r in docs.collect()]
    assert docs.columns == columns and text_key(kept) == text_key(mixed)

    # tokens, as the library makes them; and the run as a whole
    tok, rows = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), []
    for r in kept:
        ids = tok.encode(r[1], add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        rows.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    order = lambda rows: sorted(map(str, map(tuple, rows)))
    assert order(corpus_pipeline.run(spark, folder).collect()) == order(rows)


def test_run_on_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        corpus_pipeline.table(spark, folder, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
