"""Plain versions of what the operators' contracts fix, and awkward tables."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

SENTENCES = ["the quick brown fox jumps over the lazy dog near the river bank today",
             "a second line of words that nobody else in this small corpus ever wrote down",
             "третья строка на другом языке, with é and ß and 日本語 text in between",
             "numbers 1 2 3 4 5 and symbols # * $ follow each other in this line!"]
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30000))

# nulls in any column, empty and very long texts, ties, repeated rows
AWKWARD = [
    (1, "\n".join(SENTENCES), "en", "a", 1), (2, "\n".join(SENTENCES), "en", "b", 1), (2, "\n".join(SENTENCES), "en", "b", 1),
    (3, None, "en", None, None), (4, "", None, "a", 0), (None, "\n".join(SENTENCES[1:]), "fr", None, 3),
    (5, "  \n\t \n ", "en", "", 5), (6, LONG, "en", "c", 9), (7, LONG + " tail", "en", "c", 9), (None, None, None, None, None),
    (8, "one", "xx", "a", 3), (9, "x" * 20000, "en", "a", 4), (8, "another text for key eight", "en", "a", 3),
    (10, "\n".join([SENTENCES[0]] * 6), "en", "c", 2), (11, " " * 5000 + "end", "en", "c", 2), (12, "<|endoftext|> a\u0000b", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = {"row_": "1", "id": "'x'", "name": "2", "tkey": "3", "m_": "4", "size": "5", "sk": "6", "stratum": "7", "slot_x": "8", "copies": "9", "n": "10"}


def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


def clashing(df):
    return df.selectExpr("*", *[f"{v} AS `{k}`" for k, v in CLASHING.items()])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def quality_measures(text):
    found = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    windows = {}
    for i in range(len(found) - 7):
        windows.setdefault(tuple(found[i:i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def shingles(text, width=5):
    found = words(text)
    width = min(width, len(found))
    return [tuple(found[i:i + width]) for i in range(len(found) - width + 1)] if found else []


def lcs_similarity(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    common = row[-1]
    return common / (len(a) + len(b) - common) if a and b else 0.0


def targets(sizes):
    """Targets by sharing out and capping until none is above; ``sizes`` in source order."""
    total, caps = sum(sizes), [3.0 * s for s in sizes]
    weights = [k % 3 + 1 for k in range(len(sizes))]
    capped = set()
    while True:
        free = [k for k in range(len(sizes)) if k not in capped]
        rest = total - sum(caps[k] for k in capped)
        level = rest / sum(weights[k] for k in free) if free else 0
        above = {k for k in free if level * weights[k] > caps[k]}
        if not above:
            return [caps[k] if k in capped else level * weights[k] for k in range(len(sizes))]
        capped |= above


def edited(text, follower):
    third = len(text) // 3
    return text[:len(text) - third] + follower[:third]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
