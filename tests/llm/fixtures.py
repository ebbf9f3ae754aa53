"""Small documents with every awkward case, and brute-force versions of the operators."""

import collections
import hashlib
import math
import random
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AWKWARD = [
    (1, "one two three four five six seven"), (2, "ONE two three four five six seven"), (3, None), (4, ""), (5, " \n\t "), (6, "word"),
    (7, "1234 567 89"), (8, "the <|endoftext|> mark 's it's\r\n\r\n  x"), (9, "naïve café 日本語 テスト　全角 😀 \u00a0end"), (10, "aaaa" * 300),
    (11, "#### $$$ %%% ||| <<< >>>"), (12, "same line\nsame line\nother\nsame line"), (12, "same line\nsame line\nother\nsame line"),
    (13, "a b c a b c a b c"), (14, "'s"), (15, "\x1c\x1d\x85 x"), (None, "a document without an id stands here, all alone"),
    (16, "x" * 5000), (17, "lorem ipsum dolor sit amet " * 3000), (18, "One two three four five six seven eight"), (2**40, "far id"),
]


def prose(n: int = 120, seed: int = 3) -> list[tuple]:
    """Documents over a small vocabulary, with copies and near copies."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.3:
            words = rows[rng.randrange(len(rows))][1].split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.randint(3, 90))]
        rows.append((1000 + i, " ".join(words)))
    return rows


def documents(spark, rows, partitions: int = 3):
    """Rows as a documents table with more columns, some named like results."""
    full = [(i, t, "en", "src", 0, 0.5, 7, True) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, kept boolean"
    return spark.createDataFrame(full, schema).repartition(partitions)


def rows_of(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def shingle_set(text, n=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i: i + n]) for i in range(len(words) - n + 1)) or frozenset([tuple(words)])


def components(rows, percent=80):
    """Smallest reachable id per row (rows with equal ids and texts are one node each)."""
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    ids = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[root(i)].append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        known = [x for x in ids[root(i)] if x is not None]
        out.append((d, len(sets[i]), (min(known) if known else None) if sets[i] else d))
    return out


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) for j in range(3) if windows[tuple(words[i: i + 3])] > 1}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def unigram_scores(rows):
    held = {i: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for i, (d, _) in enumerate(rows)}
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    count = collections.Counter(w for i, t in enumerate(tokens) if not held[i] for w in t)
    n, v = sum(count.values()), len(count)
    return [(held[i], len(t), sum(count[w] > 0 for w in t), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t))
            for i, t in enumerate(tokens)]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
