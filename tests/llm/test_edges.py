"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm import brute
from transitlake.llm import best_fit, budget_mix, line_windows, link_graph, merkle, order_minhash, quality_classifier
from transitlake.llm import quality_rules, shard_table, tables, text, toxicity


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 0), (None, 1, 1), (6, None, None), (8, 0, 1)],
                                 "doc_id long, quality int, toxic int").cache()


def shapes(spark):
    return [("awkward", brute.awkward(spark)), ("clashing", brute.clashing(brute.awkward(spark))),
            ("empty", brute.empty(spark)), ("clashing, empty", brute.clashing(brute.empty(spark)))]


def count(name):
    return 0 if "empty" in name else len(brute.AWKWARD)


def test_classifiers(spark, labels):
    for name, docs in shapes(spark):
        model = quality_classifier.train(docs, labels, "quality")
        found = quality_classifier.score(docs, model).collect()
        assert len(found) == count(name) and all(0 <= r["score"] <= 1 for r in found)
        model = toxicity.train(docs, labels, "toxic")
        found = toxicity.score(docs, model).collect()
        assert len(found) == count(name) and all(0 <= r["score"] <= 1 for r in found)
    nothing = labels.where("false")
    assert quality_classifier.train(docs, nothing, "quality").slope == 0
    assert toxicity.train(docs, nothing, "toxic").lexicon == toxicity.fixed_lexicon()


def test_toxic_grammar():
    model = toxicity.Model({**toxicity.fixed_lexicon(), "fool": ("insult", 4.0)})
    weight = lambda text: model.weigh(text)[0]
    plain, aimed = weight("what a fool"), weight("you fool")
    assert aimed > plain > weight("he is not a fool, it rains") > 0
    assert weight("a fool") > weight("the paper reported a fool")
    assert weight("will kill. you") < weight("they will kill")
    assert weight("") == weight("nothing here") == 0
    stems = toxicity.Model({**toxicity.fixed_lexicon(), "wretch*": ("insult", 3.0), "wretched": ("insult", 5.0)})
    assert [stems.weigh(t) for t in ("a wretch", "all wretches, wretched", "wre")] == [(3.0, 2), (8.0, 3), (0.0, 1)]


def test_toxic_stems_are_learned_from_their_inflections(spark):
    """No inflection is frequent; a long clean text that holds the stem once is left alone."""
    clean = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(300))
    ends = "ab cd ef gh ij kl mn op qr st uv wx".split()
    rows = [(i, " ".join(f"{clean[7 * (i % 40 + 20 * k):][:63]} grobul{ends[(i + k) % 12]}" for k in range(3)), 1) for i in range(80)]
    rows += [(1000 + i, clean[7 * (i % 40):] + (" grobulzz" if i % 5 == 0 else ""), 0) for i in range(160)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, "toxic")
    assert any(term.startswith("grobul") and term.endswith("*") for term in model.lexicon)
    unseen = spark.createDataFrame([(1, "so grobulyy it is, grobulvv and grobuluu"), (2, clean + " grobulyy"), (3, "")], docs.schema)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(unseen, model).collect()}
    assert scores[1] > 0.7 > 0.3 > max(scores[2], scores[3])


def test_near_duplicates(spark):
    for name, docs in shapes(spark):
        found = order_minhash.near_duplicate_classes(docs).collect()
        assert len(found) == count(name)
        kept = order_minhash.drop_near_duplicates(docs)
        assert kept.columns == docs.columns
        rows = kept.collect()
        if "empty" not in name:
            classes = collections.Counter((r["doc_id"], r["class_id"]) for r in found)
            assert classes[2, 1] == 2 and classes[7, 6] == 1 and classes[5, 5] == 1
            ids = collections.Counter(r["doc_id"] for r in rows)
            assert ids[1] == 1 and ids[2] == 0 and ids[7] == 0 and ids[3] == ids[4] == ids[5] == 1
            assert ids[8] == 2 and ids[None] == 2  # different texts, and texts without words


def test_repeated_rows_keep_one(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h", "en", "s", 1)] * 5, brute.SCHEMA)
    assert order_minhash.drop_near_duplicates(docs).count() == 1


def test_banded_similarity_is_exact_above_the_floor():
    rng = random.Random(3)
    for _ in range(300):
        x = [rng.randrange(30) for _ in range(rng.randrange(1, 80))]
        y = [s if rng.random() > 0.08 else rng.randrange(30) for s in x if rng.random() > 0.05] or [1]
        exact = brute.lcs_similarity(x, y)
        found = order_minhash.banded_similarity(x, y, 0.6)
        assert found <= exact + 1e-12 and (exact < 0.6 or abs(found - exact) < 1e-12)


def test_large_group_is_linear(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[:60] + [f"own{i}"] + base[60:]), "en", "s", 1) for i in range(1200)]
    docs = spark.createDataFrame(rows, brute.SCHEMA)
    sketched = order_minhash.sketches(docs, "text")
    half = sketched.where("conv(hex(substring(tkey, 1, 1)), 16, 10) < 128")
    few, all_ = (order_minhash.first_pairs(order_minhash.buckets(part)).count() for part in (half, sketched))
    assert all_ < 2.6 * few
    assert {r["class_id"] for r in order_minhash.near_duplicate_classes(docs).collect()} == {0}


def test_twins_in_a_dense_group_are_all_found(spark):
    """Texts of one core are strangers (74 of 94 shingles), but each has a twin (76 of 92); none may be missed."""
    rng, core, rows = random.Random(5), [f"w{i}" for i in range(78)], []
    for i in range(300):
        own, other, at = [f"own{i}x{k}" for k in range(10)], list(core), rng.randrange(5, 65)
        other[at], other[at + 3] = f"p{i}", f"q{i}"
        rows += [(2 * i, " ".join(core + own), "en", "s", 1), (2 * i + 1, " ".join(other + own), "en", "s", 1)]
    for i, j in ((0, 1), (0, 2), (1, 3)):
        near = brute.lcs_similarity(brute.shingles(rows[i][1]), brute.shingles(rows[j][1]))
        assert (near >= 0.8) == (i // 2 == j // 2)
    found = order_minhash.near_duplicate_classes(spark.createDataFrame(rows, brute.SCHEMA)).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == {i: i - i % 2 for i in range(600)}


def test_exact_pairs_miss_none(spark):
    rng, base = random.Random(6), [f"w{i % 30}" for i in range(60)]
    texts = {bytes([i]): " ".join(w if rng.random() > 0.02 else rng.choice(base) for w in base[rng.randrange(4):60 - rng.randrange(6)])
             for i in range(70)}
    table = spark.createDataFrame([(bytearray(k), t) for k, t in texts.items()], "tkey binary, text string")
    runs = {k: brute.shingles(t) for k, t in texts.items()}
    near = {(a, b) for a in texts for b in texts if a < b and brute.lcs_similarity(runs[a], runs[b]) >= 0.8}
    for joined in (set(), set(sorted(near)[::9])):
        links = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in joined], "a binary, b binary")
        root = {bytes(r["node"]): bytes(r["root"]) for r in tables.connected_components(links).collect()}
        found = {(bytes(r["a"]), bytes(r["b"])) for r in order_minhash.exact_pairs(table, links, salted=4).collect()}
        apart = {(a, b) for a, b in near if root.get(a, a) != root.get(b, b)}
        assert len(near) > 100 and apart and apart <= found
        assert all(root.get(a, a) != root.get(b, b) for a, b in found)


def test_near_copies_with_null_or_equal_keys_keep_one(spark):
    texts = [" ".join([*(f"w{i}" for i in range(60)), f"end{k}"]) for k in range(4)]
    for keys in ([None] * 4, [5] * 4, [None, 5, None, 5]):
        docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in zip(keys, texts)] * 2, brute.SCHEMA)
        kept = order_minhash.drop_near_duplicates(docs).collect()
        assert [r["doc_id"] for r in kept] == [max((k for k in keys if k), default=None)]


def test_link_graph(spark):
    rules = [("good.org", "/", "allow"), ("bad.org", "/", "block")]
    link = "<a href='{}'>x</a>"
    pages = spark.createDataFrame([
        (1, "http://good.org/", link.format("//Friend.org/a?b")), (2, "https://bad.org/x#y", link.format("/own")),
        (3, "http://shady.org/?q", link.format("http://BAD.org")), (4, "http://friend.org/", None), (5, None, "<a href=x>"),
        (6, "no scheme", None), (7, "http://sub.bad.org/p", None), (7, "http://sub.bad.org/p", None), (None, "http://alone.org", ""),
    ], "page_id long, url string, html string")
    found = {r["page_id"]: r for r in link_graph.judge(pages, rules, threshold=0.15).collect()}
    assert [found[k]["verdict"] for k in (1, 2, 3, 4, 5, 6, 7, None)] == \
        ["allow", "block", "block", "allow", "allow", "allow", "block", "allow"]
    assert found[4]["trust"] > 0 == found[4]["distrust"] and (found[5]["host"], found[6]["path"]) == ("", "")
    assert found[7]["rule"] == "bad.org/" and found[3]["rule"] is None
    assert link_graph.judge(pages.where("false"), rules).count() == 0


def test_links_decide_by_default(spark):
    """Default parameters: links between hosts against a plain propagation."""
    links = {"bad.org": ["bad.org"] * 6, "good.org": ["good.org", "liked.org", "liked.org"], "farm1.org": ["bad.org"] * 3 + ["farm1.org"] * 9,
             "farm2.org": ["farm1.org", "bad.org"], "half.org": ["bad.org", "good.org"], "third.org": ["bad.org", "good.org", "alone.org"],
             "far.org": ["farm2.org"], "liked.org": ["bad.org"], "alone.org": ["alone.org"], "none.org": []}
    links |= {f"w{i}.org": ["bad.org"] + ["good.org"] * 4 for i in range(5)}
    pages = [(i, f"http://{h}/", "".join(f"<a href='http://{x}/'>" for x in to)) for i, (h, to) in enumerate(links.items())]
    found = {r["host"]: r for r in link_graph.judge(spark.createDataFrame(pages, "page_id long, url string, html string"),
                                                    [("good.org", "/", "allow"), ("bad.org", "/", "block")]).collect()}
    blocked, allowed = ({h: float(h == x) for h in links} for x in ("bad.org", "good.org"))
    out = {h: [x for x in to if x != h] for h, to in links.items()}
    into = {h: [x for x in out for y in out[x] if y == h] for h in links}
    known = {h: blocked[h] + allowed[h] for h in links}
    trust, distrust, sent, sent_back = dict(allowed), dict(blocked), dict(known), dict(known)
    for _ in range(12):
        trust, distrust, sent, sent_back = (
            {h: (seed[h] + sum(score[x] / len(back[x]) for x in to[h]) + (0 if back[h] else score[h])) / 2 for h in links}
            for seed, score, to, back in ((allowed, trust, into, out), (blocked, distrust, out, into), (known, sent, into, out), (known, sent_back, out, into)))
    share = lambda score, whole, h: score[h] / whole[h] if whole[h] else 0.0
    for h, r in found.items():
        assert r["trust"] == pytest.approx(trust[h]) and r["distrust"] == pytest.approx(distrust[h])
        assert r["verdict"] == ("block" if share(distrust, sent_back, h) - share(trust, sent, h) >= 0.5 else "allow")
    # one blocked host suffices, however many others link to it; a host that trusted ones link to, or that mostly links to them, stays
    assert {h for h, r in found.items() if r["verdict"] == "block"} == {"bad.org", "farm1.org", "farm2.org", "half.org", "third.org", "far.org"}


def test_line_windows(spark):
    for name, docs in shapes(spark):
        found = line_windows.deduplicate_lines(docs)
        assert found.columns == [*docs.columns, "n_lines_", "n_removed_"]
        rows = found.collect()
        assert len(rows) == count(name)
        if "empty" not in name:
            by = collections.defaultdict(list)
            for r in rows:
                by[r["doc_id"]].append((r["text"], r["n_lines_"], r["n_removed_"]))
            # the null key comes first, so its three lines stay
            assert by[1] == [(brute.SENTENCES[0], 4, 3)] and by[2] == [("", 4, 4)] * 2
            assert by[3] == [(None, 0, 0)] and by[4] == [("", 1, 0)] and by[10] == [(brute.SENTENCES[0], 6, 5)]
        assert line_windows.lines_removed(docs).count() == max(0, count(name) - 2)  # both rows of key 2 are emptied


def test_columns_named_like_results(spark):
    """They give way to the results, and stages that only filter keep them."""
    docs = brute.awkward(spark).selectExpr("*", "'mine' AS n_lines_", "'mine' AS n_removed_", "'mine' AS slot_", "'mine' AS shard_", "'mine' AS taken")
    plain = brute.awkward(spark)
    removed = line_windows.lines_removed(docs)
    assert removed.columns == docs.columns and {r["n_removed_"] for r in removed.collect()} == {"mine"}
    assert sorted(map(repr, removed.select(*plain.columns).collect())) == sorted(map(repr, line_windows.lines_removed(plain).collect()))
    found = line_windows.deduplicate_lines(docs)
    assert found.columns.count("n_lines_") == 1 and sum(r["n_removed_"] for r in found.collect()) == sum(
        r["n_removed_"] for r in line_windows.deduplicate_lines(plain).collect())
    placed = shard_table.place(docs)
    assert placed.columns.count("slot_") == placed.columns.count("shard_") == 1
    assert sorted((r["slot_"], r["shard_"]) for r in placed.collect()) == sorted((r["slot_"], r["shard_"]) for r in shard_table.place(plain).collect())


def test_shards(spark):
    names = shard_table.shard_names(7)
    owners = shard_table.fill(names, 1009)
    sizes = collections.Counter(owners)
    assert set(owners) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    fewer = shard_table.fill(names[:-1], 1009)
    assert sum(a != b for a, b in zip(owners, fewer) if a != 6) < 1009 * 0.15
    with pytest.raises(ValueError):
        shard_table.fill(names, 1000)
    for name, docs in shapes(spark):
        placed = shard_table.place(docs, "doc_id", names, 1009)
        assert placed.columns == [*docs.columns, "slot_", "shard_"] and placed.count() == count(name)


def test_mix(spark):
    for name, docs in shapes(spark):
        rows = budget_mix.mix_sources(docs).collect()
        assert len(rows) == count(name) and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
        mixed = budget_mix.mixed_documents(docs)
        assert mixed.columns == docs.columns
        words = sum(len(brute.words(r["text"])) for r in mixed.collect())
        assert words == sum(r["taken"] for r in rows)


def test_subset_sums_hit_the_budget():
    rng = np.random.default_rng(1)
    sizes, counts = np.arange(1, 200), rng.integers(0, 9, 199)
    total = int((sizes * counts).sum())
    for budget in rng.integers(0, total + 1, 60).tolist():
        chosen = budget_mix.fit_subset(sizes, counts, budget, 0.5)
        assert (chosen >= 0).all() and (chosen <= counts).all() and abs(int((sizes * chosen).sum()) - budget) <= 1


def test_budgets_that_a_fixed_share_would_miss():
    """Every sum that some choice of documents has is hit."""
    for sizes, counts in (([2, 3], [1000, 1]), ([2, 7, 50], [40, 3, 2]), ([6, 10, 15], [60, 60, 60])):
        sums = {0}
        for size, n in zip(sizes, counts):
            sums = {s + k * size for s in sums for k in range(n + 1)}
        step = max(1, len(sums) // 700)
        for budget in sorted(sums)[::step]:
            chosen = budget_mix.fit_subset(np.array(sizes), np.array(counts), budget, 0.5)
            assert int((np.array(sizes) * chosen).sum()) == budget and (chosen <= np.array(counts)).all() and (chosen >= 0).all()


def test_quality_rules(spark, labels):
    for name, docs in shapes(spark):
        rows = quality_rules.judge(docs, labels).collect()
        assert len(rows) == count(name)
        kept = quality_rules.keep_good(docs, labels)
        assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in rows)
    texts = [t for _, t, *_ in brute.AWKWARD] + ["a b c d e f g h " * 4, "x\n\nx\nx y\nx y", "# # ## é日 " * 9]
    found = [row for b in text.blocks(pa.array(texts, pa.string()), 300) for row in quality_rules.measures(b)]
    assert [tuple(int(v) for v in f[:5]) for f in found] == [brute.quality_measures(t) for t in texts]


def test_binomial_bound():
    assert abs(quality_rules.binomial_cdf(2, 10, 0.3) - 0.3827827864) < 1e-9
    for n, p in ((1, 0.5), (7, 0.03), (60, 0.9), (400, 0.006)):
        for x in range(n + 1):
            plain = sum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(x + 1))
            assert quality_rules.binomial_cdf(x, n, p) == pytest.approx(plain, rel=1e-9)
    assert quality_rules.binomial_cdf(60_000_000, 10 ** 10, 0.006) == pytest.approx(0.5, abs=0.001)  # at once, however many labels
    assert quality_rules.certify([0, 0, 50], 1000, 0.006, 0.05, (0.5, 0.3, 0.1)) == 0.3
    assert quality_rules.certify([0], 20, 0.006, 0.05, (0.5,)) is None


def test_cutoffs_hold_their_risk(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(["word"] * 3 + [f"w{i}x{k}" for k in range(30)]) + " #" * int(rng.random() < 0.002)
             + (" #$%" * 20 if i % 7 == 0 else ""), "en", "s", 1) for i in range(6000)]
    docs = spark.createDataFrame(rows, brute.SCHEMA)
    marks = spark.createDataFrame([(i, int(i % 7 != 0)) for i in range(6000)], "doc_id long, quality int")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs, marks).collect()}
    good = [kept[i] for i in range(6000) if i % 7]
    assert 1 - sum(good) / len(good) <= quality_rules.RISK and not any(kept[i] for i in range(0, 6000, 7))


def test_packing(spark):
    for name, docs in shapes(spark):
        rows = best_fit.pack_documents(docs, with_ids=True).collect()
        assert all(len(r["ids"]) == r["length"] for r in rows)
        ends = sum(r["ids"][-1] == 2 and r["ids"].count(2) >= 1 for r in rows)
        assert ends >= count(name)
    rng = np.random.default_rng(2)
    sizes = collections.Counter(rng.integers(1, 65, 3000).tolist())
    sequences, ranks = collections.defaultdict(list), collections.Counter()
    for size, rank, many, first, each, at in best_fit.pack_rounds(sizes, 64):
        assert rank == ranks[size]
        ranks[size] += many
        for k in range(many):
            sequences[first + k // each].append((at + k % each * size, size))
    assert ranks == sizes
    for parts in sequences.values():
        end = 0
        for at, size in sorted(parts):
            assert at == end
            end += size
        assert end <= 64
    assert len(sequences) <= 1.02 * -(-sum(s * n for s, n in sizes.items()) // 64) + 1


def test_tokens_equal_the_tokenizer_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(9)
    alphabet = "abc XYZ 0123 \n\t  .,'!? éßñ日本\u0000  😀 's 'll <|endoftext|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 400))) for _ in range(300)]
    texts += [" " * 3000 + "x", "a" * 5000, brute.LONG, brute.LONG * 3, "it's <|endoftext|>\n\n  we'll"]
    for own in texts:
        assert best_fit.encode(own).tolist() == tokenizer.encode(own, add_special_tokens=False).ids


def test_merkle(spark):
    for name, docs in shapes(spark):
        rows = merkle.followed(docs, parts=3).collect()
        assert len(rows) == count(name)
        order = sorted((d for d in docs.collect()), key=lambda d: (d["doc_id"] is None, -(d["doc_id"] or 0), d["text"] or ""))
        wanted = collections.Counter(
            (d["doc_id"], brute.sha(brute.edited(d["text"] or "", n["text"] or ""))) for d, n in zip(order, order[1:] + order[:1]))
        assert collections.Counter((r["doc_id"], r["edited_sha256"]) for r in rows) == wanted
        assert merkle.fingerprints(docs).count() == count(name)
    one = "first line of words here\nsecond line of other words\n\nthird one at the end"
    two = one.replace("other", "changed")
    a, b = merkle.tree(one.encode()), merkle.tree(two.encode())
    sections = [name for name, _ in merkle.parsed(a[0])]
    assert len(a[0].partition("|")[0]) == 32 and all(len(name) == 8 for name in sections)
    assert a[0].partition("|")[0] != merkle._hash("".join(sections).encode(), 16)  # over whole digests, not the printed names
    spans = merkle.differences(a[0], b[0])
    at = two.encode().index(b"changed")
    assert spans and any(s <= at and at + 7 <= e for s, e in spans) and merkle.differences(a[0], a[0]) == []
    assert 0 < merkle.likeness(a, b) < 1 == merkle.likeness(a, a)


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (200, 100)], "a long, b long")
    found = {r["node"]: r["root"] for r in tables.connected_components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 100}


def test_pipeline(spark, labels, tmp_path):
    for name, docs in shapes(spark)[:1] + shapes(spark)[2:3]:
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        now = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = tables.stored(stage(spark, now, folder), "test")
            assert now.columns == docs.columns
        rows = corpus_pipeline.run(spark, folder).collect()
        assert sum(r["piece"] == 0 for r in rows) == now.count()
