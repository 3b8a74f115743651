"""The pipeline's stages on a small corpus against plain Python: kept ids, texts, copies, places."""

import collections

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import brute
from transitlake.llm.tables import stored

RNG = np.random.default_rng(11)
VOCABULARY = [f"w{k}" for k in range(3000)]


def prose(words, lines=1):
    found = RNG.choice(VOCABULARY, words).tolist()
    cut = max(1, words // lines)
    return "\n".join(" ".join(found[k:k + cut]) for k in range(0, words, cut))


def corpus():
    """Good texts, short and repetitive ones, shared passages, copies near and exact, keys that are null or repeated."""
    shared = prose(60, 4)
    rows = [(k, prose(int(RNG.integers(25, 160)), int(RNG.integers(1, 6)))) for k in range(40)]
    rows += [(100 + k, prose(30, 2) + "\n" + shared + "\n" + prose(30, 2)) for k in range(6)]
    base = [prose(150) for _ in range(4)]
    for k, text in enumerate(base):
        words = text.split(" ")
        rows.append((200 + 10 * k, text))
        rows.append((201 + 10 * k, " ".join([*words[:70], "changed", *words[71:]])))  # 5 of 146 shingles differ
        rows.append((202 + 10 * k, text))
        rows.append((203 + 10 * k, " ".join(words[:75] + RNG.choice(VOCABULARY, 75).tolist())))  # half of it: no copy
    rows += [(300, "too short"), (301, None), (302, ""), (303, "a b c d e f g h i j " * 6), (None, base[0]), (304, "\n".join([shared] * 2))]
    return [(key, text, "en" if at % 3 else "fr", "abc"[at % 3], None if text is None else len(text)) for at, (key, text) in enumerate(rows)]


def plain_quality(rows):
    return [r for r in rows if (m := brute.quality_measures(r[1]))[0] >= 20 and 100 * m[4] <= 30 * m[0]]


def plain_lines(rows):
    order = sorted({(r[0], r[1]) for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    seen, covered = set(), collections.defaultdict(set)
    for key, text in order:
        lines = text.split("\n")
        for at in range(len(lines) - 2):
            window = "\n".join(lines[at:at + 3])
            if brute.words(window):
                if window in seen:
                    covered[key, text] |= {at, at + 1, at + 2}
                seen.add(window)
    out = []
    for key, text, *rest in rows:
        gone = covered.get((key, text), ())
        left = "\n".join(line for at, line in enumerate((text or "").split("\n")) if at not in gone) if gone else text
        if not gone or brute.words(left):
            out.append((key, left, *rest))
    return out


def plain_near(rows):
    """One row of each class of texts with a similarity of 0.8 or more, that with the least key."""
    texts = sorted({r[1] for r in rows if brute.words(r[1])})
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    shingles = {t: brute.shingles(t) for t in texts}
    for a, one in enumerate(texts):
        for other in texts[:a]:
            if set(shingles[one]) & set(shingles[other]) and brute.lcs_similarity(shingles[one], shingles[other]) >= 0.8:
                root[find(one)] = find(other)
    classes = collections.defaultdict(list)
    for r in rows:
        if brute.words(r[1]):
            classes[find(r[1])].append(r)
    kept = [r for r in rows if not brute.words(r[1])]
    return kept + [min(own, key=lambda r: (r[0] is None, r[0] or 0)) for own in classes.values()]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage is given and returns."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.createDataFrame(corpus(), brute.SCHEMA)
    docs.write.parquet(f"{folder}/documents.parquet")
    # too few labels to certify a cutoff: the base rule alone rejects
    spark.createDataFrame([(k, 1, 0) for k in range(10)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    out = [sorted(map(tuple, docs.collect()), key=repr)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), "truth")
        out.append(sorted(map(tuple, docs.collect()), key=repr))
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    final = sorted(map(tuple, corpus_pipeline.run(spark, folder).select("doc_id", "piece", "length").collect()), key=repr)
    return out, final, docs.columns


@pytest.mark.parametrize("at, plain", [(0, plain_quality), (1, plain_lines), (2, plain_near)])
def test_filtering_stages(stages, at, plain):
    before, after = stages[0][at], stages[0][at + 1]
    assert after == sorted(plain(before), key=repr)
    assert len(after) < len(before) or at == 1


def test_mix(stages):
    """Each document is there as often as the mix takes it, no more than three times; sources come near their targets."""
    before, after = stages[0][3], stages[0][4]
    times = collections.Counter(after)
    assert set(times) <= set(before) and max(times.values()) <= 3
    sizes = collections.Counter()
    taken = collections.Counter()
    for r in before:
        sizes[r[3]] += len(brute.words(r[1]))
    for r, n in times.items():
        taken[r[3]] += n * len(brute.words(r[1]))
    sources = sorted(sizes)
    for source, target in zip(sources, brute.targets([sizes[s] for s in sources])):
        assert abs(taken[source] - target) <= 1.5


def test_packing(stages):
    """Every document's ids in order, in pieces that fill sequences without gaps."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    before, after, columns = stages[0][4], stages[0][5], stages[2]
    rows = [dict(zip(columns, r)) for r in after]
    assert sorted((r["doc_id"], r["piece"], r["length"]) for r in rows) == sorted(stages[1])
    places = collections.defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    wanted = sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in before)
    assert sum(r["length"] for r in rows) == wanted
    assert len(places) <= -(-wanted // 1024) * 1.25 + 1
