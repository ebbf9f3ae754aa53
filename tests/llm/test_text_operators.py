"""BPE, packing, chat formatting, language-model scores, quality rules, language ID and the Jaccard join."""

import collections
import os
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from vitrine.llm import bpe, chat, jaccard, langid, lm, packing, quality, words

from .fixtures import AWKWARD, components, documents, prose, quality_counts, rows_of, sha, unigram_scores

os.environ["TOKENIZERS_PARALLELISM"] = "false"
ALL = [AWKWARD, prose(80), []]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(bpe.default_path())


def test_word_keys_match_words():
    texts = [t for _, t in AWKWARD + prose(30)]
    (_, _, data, off), = words.slices(pa.array(texts))
    keys, first = words.word_keys(data, off, True)
    split = [(t or "").encode().lower().split() for t in texts]
    assert np.diff(first).tolist() == [len(s) for s in split]
    by = {}
    for k, w in zip(keys.tolist(), [w for s in split for w in s]):
        assert by.setdefault(w, k) == k
    assert len(set(by.values())) == len(by)


def test_bpe_matches_tokenizers(reference):
    rng = random.Random(5)
    parts = ["a", "b", "'", "s", "t", " ", "\n", "é", "日", "1", ".", "!", "\u00a0", "\u2003", "ll", "re", "<|", "<|endoftext|>", "😀", "-", "'s", "\t", "\x1c"]
    texts = [t or "" for _, t in AWKWARD] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    encoder = bpe.load(bpe.default_path())
    want = [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(pa.array(texts))] == want
    encoder.cache.clear()
    for ids in want[:200]:
        assert encoder.decode(np.array(ids)) == reference.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("rows", ALL)
def test_bpe_query(spark, reference, rows):
    got = collections.Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows_of(bpe.round_trip_digests(documents(spark, rows))))
    want = collections.Counter()
    for i, t in rows:
        ids = reference.encode(t or "", add_special_tokens=False).ids
        want[(i, len(ids), sha(",".join(map(str, ids))), sha(t or ""))] += 1
    assert got == want


@pytest.mark.parametrize("rows", ALL)
def test_packing(spark, reference, rows):
    got = rows_of(packing.pack_documents(documents(spark, rows)))
    want = collections.Counter()
    for i, t in rows:
        ids = [*reference.encode(t or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in got)
    assert -(-total // 1024) <= len(sequences) <= 1.2 * total / 1024 + 2


def test_packing_plan_is_exact_and_near_the_bound():
    rng = np.random.default_rng(1)
    sizes = np.minimum(1024, rng.lognormal(6, 1, 20_000).astype(int) + 1)
    histogram = dict(collections.Counter(sizes.tolist()))
    found = packing.plan(histogram)
    held = collections.Counter()
    for lengths, copies in found:
        assert sum(lengths) <= 1024
        for s in lengths:
            held[s] += copies
    assert held == histogram
    assert sum(c for _, c in found) <= 1.01 * max(sizes.sum() / 1024, (sizes > 512).sum()) + 3
    slots = collections.Counter()
    for size, first, per, _, _, copies in packing.plan_slots(found):
        assert first == slots[size]
        slots[size] += per * copies
    assert slots == histogram


@pytest.mark.parametrize("n", [1, 600, 10_000])
def test_packing_plan_takes_configurations_that_are_not_full(n):
    found = packing.plan({400: n, 320: n, 300: n})  # 1,020 tokens together
    assert sum(c for _, c in found) == n
    found = packing.plan({515: n, 250: 2 * n, 510: n, 260: 3 * n})
    assert sum(c for _, c in found) <= 2.5 * n + 1


def test_best_fit_moves_equal_sequences_together():
    rng = np.random.default_rng(2)
    for _ in range(20):
        sizes = np.unique(rng.integers(1, 100, 12))
        left = rng.integers(1, 40, len(sizes))
        bins, want = [], collections.Counter()
        for s in np.repeat(sizes, left)[::-1].tolist():
            room = min((100 - sum(b) for b in bins if sum(b) + s <= 100), default=None)
            if room is None:
                bins.append([s])
            else:
                next(b for b in bins if 100 - sum(b) == room).append(s)
        found = packing._best_fit(left, sizes, 100)
        for c, n in found.items():
            for i, a in c:
                want[i] += a * n
            assert sum(int(sizes[i]) * a for i, a in c) <= 100
        assert want == collections.Counter(dict(enumerate(left.tolist())))
        assert sum(found.values()) == len(bins)
    assert sum(c for _, c in packing.plan({700: 10**10, 650: 10**9})) == 11 * 10**9
    assert len(packing.plan({s: 10**8 for s in range(600, 901)})) < 10_000


CONVERSATIONS = [(1, 0, "user", "hi [INST] \\ <s>"), (1, 1, "assistant", None), (1, 2, None, "odd ] role"), (1, 3, "assistant", " </s> "), (2, None, "assistant", "b"),
                 (2, 5, "system[x]", "twice"), (2, 5, "system[x]", "twice"), (None, 0, "user", "no id\n"), *[(3, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(200)]]


def test_chat_digests(spark):
    df = spark.createDataFrame([(*r, 1) for r in CONVERSATIONS], "conv_id long, turn long, role string, text string, n_turns int").repartition(4)
    got = {r["conv_id"]: r for r in rows_of(chat.digests(chat.formatted(df)))}
    by = collections.defaultdict(list)
    for c, t, role, text in sorted(CONVERSATIONS, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by[c].append((role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"], got[c]["loss_sha256"], got[c]["formatted_chars"], got[c]["rewrites_history"]) == (
            len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned), len(chat.instruction_template(turns)), False)
    assert chat.digests(chat.formatted(df.limit(0))).count() == 0


def test_rewriting_templates_are_detected():
    def counts_turns(turns):
        return f"{len(turns)} turns:" + "".join(t for _, t in turns)
    turns = [("user", "a"), ("assistant", "b")]
    assert chat.locate(counts_turns, turns)[2] == 0
    text, spans, rewritten = chat.locate(chat.instruction_template, turns)
    assert rewritten == -1 and [text[s[2]:s[3]] for s in spans] == ["a", "b"] and chat.read_back(text) == turns


def test_templates_see_the_whole_conversation(spark):
    def numbers(turns):
        return "".join(f"{turns[0][0]}{i}:{t};" for i, (_, t) in enumerate(turns))

    def forgets(turns):  # drops an early turn after turn 100
        return chat.instruction_template(turns if len(turns) <= 100 else turns[:5] + turns[6:])
    texts = {c: [f"c{c}t{t}" for t in range(200)] for c in (1, 2)}
    rows = [(c, t * (1, 10)[c - 1], ("user", "assistant")[t % 2], text) for c in texts for t, text in enumerate(texts[c])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = collections.defaultdict(list)
    for r in sorted(rows_of(chat.formatted(df, numbers)), key=lambda r: r["chunk"]):
        assert r["rewritten"] == -1
        got[r["conv_id"]] += [(r["text"], [r["text"][a:b] for a, b in zip(r["starts"], r["ends"])])]
    for c, own in texts.items():
        assert "".join(x for x, _ in got[c]) == numbers([("user", t) for t in own]) and [t for _, ts in got[c] for t in ts] == own
    found = chat.formatted(df, forgets)
    for c, own in texts.items():
        chunks = sorted(rows_of(found.where(f"conv_id = {c}")), key=lambda r: r["chunk"])
        assert [r["rewritten"] for r in chunks] == [-1, 36, 0, 0]
        assert [t for _, t in chat.read_back(chunks[-1]["text"])] == own[:5] + own[6:]
        assert not any(x for r in chunks[1:] for x in r["starts"] + r["ends"])
    assert all(r["rewrites_history"] and r["n_turns"] == 199 for r in rows_of(chat.digests(found)))


@pytest.mark.parametrize("rows", ALL)
@pytest.mark.parametrize("limit", [lm.MAX_FILTER_BYTES, 300])
def test_lm_scores(spark, rows, limit):
    got = rows_of(lm.scored(documents(spark, rows), limit))
    want = unigram_scores(rows)
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    have = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key)
    for a, b in zip(have, sorted(((i, *w) for (i, _), w in zip(rows, want)), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(r["score"] <= 0 for r in got)
    if len(rows) > 50:
        gains = [r["score"] - r["base_score"] for r in got if not r["held_out"]]
        assert sum(g > 0 for g in gains) > 0.9 * len(gains)


def test_lm_filter_rounds_agree(spark):
    rows = prose(60, seed=8)
    one, many = ({r["doc_id"]: r["score"] for r in rows_of(lm.scored(documents(spark, rows), n))} for n in (lm.MAX_FILTER_BYTES, 500))
    assert one == pytest.approx(many)


def test_bloom_levels_are_never_too_low():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64))
    counts = rng.zipf(1.5, len(keys))
    level, bucket = lm.level_of(counts, 1.5), lm._bucket(keys, 4)
    segments = [(b, lm.build_segment((words.U64(b) << words.U64(32)) | (keys[bucket == b] & lm._LOW), level[bucket == b])) for b in range(4)]
    found = lm.Filter(4, segments).levels(keys)
    assert (found >= level).all() and (found == level).mean() > 0.9
    assert (lm.Filter(4, segments).levels(rng.integers(0, 2**63, 5000).astype(np.uint64)) == 0).mean() > 0.9


@pytest.mark.parametrize("rows", ALL)
def test_quality_counts(spark, rows):
    model = quality.fit_trees(np.zeros((0, len(quality.FEATURES))), np.zeros(0), list(quality.FEATURES.values()))
    got = collections.Counter((r["doc_id"], *(r[c] for c in quality.COUNTS), r["base_failed"], r["kept"]) for r in rows_of(quality.judged(documents(spark, rows), model)))
    want = collections.Counter()
    for i, t in rows:
        c = quality_counts(t)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        want[(i, *c, failed, not failed)] += 1
    assert got == want


def test_trees_learn_and_keep_their_constraints():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = (((x[:, 0] < 0.6) & (x[:, 1] > 0.2)) ^ (rng.random(3000) < 0.03)).astype(float)  # monotone, with some wrong labels
    model = quality.fit_trees(x, y, [-1, 1, 0])
    assert ((quality.score_trees(model, x) > 0.5) == y).mean() > 0.93
    grid = np.repeat(rng.random((50, 1, 3)), 40, axis=1)
    for f, sign in ((0, -1), (1, 1)):
        moved = grid.copy()
        moved[:, :, f] = np.linspace(0, 1, 40)
        s = quality.score_trees(model, moved.reshape(-1, 3)).reshape(50, 40)
        assert (sign * np.diff(s, axis=1) >= -1e-12).all()
    assert quality.score_trees(quality.fit_trees(x, np.ones(3000), [0, 0, 0]), x).min() >= 0.5


def test_language_id(spark):
    rng = random.Random(4)
    syllables = {"aa": "ka ne to su mi", "bb": "sch ung der ein ver", "cc": "eau que oui tre les", "dd": "ción ado los que ez"}
    rows = [(i, " ".join("".join(rng.choice(s.split()) for _ in range(3)) for _ in range(40)), lang) for i, (lang, s) in
            enumerate(list(syllables.items()) * 40)]
    train = spark.createDataFrame(rows[:120] + [(900, None, "aa"), (901, "x", None)], "doc_id long, text string, lang string")
    model = langid.train(train)
    assert model.languages == sorted(syllables)
    test = documents(spark, [(i, t) for i, t, _ in rows[120:]] + [(500, None), (501, ""), (502, "12 34 !!")])
    got = {r["doc_id"]: r for r in rows_of(langid.predicted(test, model))}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows[120:])
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (500, 501, 502))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.predicted(test.limit(0), model).count() == 0
    assert {r["lang_pred"] for r in rows_of(langid.predicted(test, langid.train(train.limit(0))))} == {"und"}


@pytest.mark.parametrize("k", [1, 2, 4, 8, 20])
def test_codewords_are_apart(k):
    codes = langid.codewords(k)
    assert len(codes) == k and all((codes[i] != codes[j]).any() for i in range(k) for j in range(i))


def near_group(n, seed=1):
    """A large group of near copies of one text."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(300)] = f"x{rng.random()}"
        rows.append((5000 + i, " ".join(w)))
    return rows


@pytest.mark.parametrize("rows", [AWKWARD, prose(150), near_group(60) + prose(20) + [(9000 + i, "the very same words in all of these") for i in range(40)], []])
def test_jaccard_components(spark, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_TOKENS", 4000)
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows_of(jaccard.jaccard_components(documents(spark, rows))))
    assert got == collections.Counter(components(rows))


def test_verification_of_many_short_sets_is_bounded_in_memory():
    n = 4000
    apart = [[*range(5), 1000 + i] for i in range(n)]                       # 5 of 7 alike
    near = [[*range(100, 119), 100_000 + i] for i in range(n)]              # 19 of 21 alike
    tokens = [np.array(x, np.uint64) for x in apart + near]
    rows = pa.table({"node": pa.array(range(2 * n), pa.int64()), "tile": pa.array([i % 2 for i in range(2 * n)], pa.int64()),
                     "i": pa.array([0] * 2 * n, pa.int64()), "j": pa.array([1] * 2 * n, pa.int64()), "tokens": [x.tobytes() for x in tokens],
                     "prefix": pa.array([x[:1].tolist() for x in tokens], pa.list_(pa.int64())), "others": [[x[1:2].tobytes()] for x in tokens]})
    tracemalloc.start()
    found = jaccard._verifier(80)(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    links = list(zip(found["a"].to_pylist(), found["b"].to_pylist()))
    assert all(a >= n and b >= n for a, b in links) and len(links) == n - 1 and len({x for pair in links for x in pair}) == n
