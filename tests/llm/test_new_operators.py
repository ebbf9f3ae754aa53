"""Alignment, periodic runs and WARC archives against brute-force versions."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from vitrine.llm import align, periods, warc
from vitrine.llm import queries as Q
from vitrine.llm import words as W

from .fixtures import AWKWARD, WORD, documents, prose, rows_of, sha

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ alignment
MORE = [(50, "▁ a literal mark"), (51, "  two  spaces  and </s> <s> <0x41> [INST]"), (52, "<|endoftext|>"), (53, "a" * 3000 + " " * 40 + "b"),
        (54, "日本語のテキスト。" * 50), (55, "\x00\x01 control"), (56, " "), (57, "x́ é ﬁ ｆ"), (58, "one\ttab\r\nline")]


def brute_alignment(rows):
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    signs = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = {chr(x): x for x in signs} | {chr(256 + i): x for i, x in enumerate(sorted(set(range(256)) - set(signs)))}

    def piece(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    per, holders = [], collections.Counter()
    for _, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [piece(i) for i in ids_b]
        if not text or not (b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode()):
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        links, j0 = [], 0
        for i, (end, t) in enumerate(zip(ends_a, bytes_a)):
            while j0 < len(ends_b) and ends_b[j0] <= end - len(t):
                j0 += 1
            j = j0
            while j < len(ends_b) and ends_b[j] - len(bytes_b[j]) < end:
                links.append((ids_a[i], ids_b[j]))
                j += 1
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, i, j = [], 0, 0
        for c in cuts:
            u, v = i, j
            while i < len(ends_a) and ends_a[i] <= c:
                i += 1
            while j < len(ends_b) and ends_b[j] <= c:
                j += 1
            groups.append(",".join(map(str, ids_a[u:i])) + "|" + ",".join(map(str, ids_b[v:j])))
        per.append((len(ids_a), len(ids_b), links, groups))
        holders.update(set(links))
    most = collections.Counter()
    for (x, _), n in holders.items():
        most[x] = max(most[x], n)
    return [(d, na, nb, len(groups), len(links), sum(holders[k] == most[k[0]] for k in links), sum(holders[k] for k in links),
             sha(";".join(groups)) if groups else "") for (d, _), (na, nb, links, groups) in zip(rows, per)]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("chunk_bytes,lane_bytes", [(align.CHUNK_BYTES, align.LANE_BYTES), (700, 16)])
def test_alignment(spark, chunk_bytes, lane_bytes):
    rows = AWKWARD + MORE + prose(60)
    got = [tuple(r[c] for c in COLUMNS) for r in rows_of(align.aligned(documents(spark, rows), chunk_bytes=chunk_bytes, lane_bytes=lane_bytes))]
    assert key(got) == key(brute_alignment(rows))


def test_alignment_lists(spark):
    rows = [(1, "The quick brown fox, 日本 jumps"), (2, None), (3, "naïve " * 200)]
    tokens = align.load(*align.default_paths())
    for r in rows_of(align.alignments(documents(spark, rows), lane_bytes=32)):
        text = dict(rows)[r["doc_id"]]
        if not text:
            assert r["a_ids"] == r["link_a"] == []
            continue
        end_a = np.cumsum(tokens.size_a[r["a_ids"]])
        end_b = np.cumsum(tokens.size_b[r["b_ids"]])
        overlap = {(i, j) for i, (e, x) in enumerate(zip(end_a, r["a_ids"])) for j, (f, y) in enumerate(zip(end_b, r["b_ids"]))
                   if max(e - tokens.size_a[x], f - tokens.size_b[y]) < min(e, f)}
        assert set(zip(r["link_a"], r["link_b"])) == overlap and len(r["link_a"]) == len(overlap)
        assert r["a_group"][0] == r["b_group"][0] == 0 and r["a_group"][-1] == r["b_group"][-1] == len(set(end_a) & set(end_b)) - 1


def test_texts_fall_apart_where_runs_of_spaces_begin(monkeypatch):
    tokens = align.load(*align.default_paths())
    rng = random.Random(1)
    texts = ["".join(rng.choice(["word", "  ", " ", "\n", "日本", ".", "      ", "a"]) for _ in range(rng.randint(1, 300))) for _ in range(200)] + [" ", "   ", "x "]
    whole = [tokens.b.encode(t) for t in texts]
    column = pa.array([" " + t for t in texts])
    monkeypatch.setattr(align, "CACHE_FRAGMENTS", 10)
    assert [x.tolist() for x in tokens.encode_b(column)] == whole
    monkeypatch.setattr(tokens, "cuttable", False)
    assert [x.tolist() for x in tokens.encode_b(column)] == whole


def test_alignment_of_no_rows(spark):
    assert rows_of(align.aligned(documents(spark, []))) == []
    assert rows_of(align.alignments(documents(spark, []))) == []


# ------------------------------------------------------------------ periodic runs
def brute_runs(words):
    n, out = len(words), []
    for p in range(1, n // 4 + 1):
        start = None
        for i in range(n - p + 1):
            equal = i < n - p and words[i] == words[i + p]
            if equal and start is None:
                start = i
            if not equal and start is not None:
                length = i - start + p
                part = words[start: start + length]
                if length >= max(6, 4 * p) and not any(part[q:] == part[:-q] for q in range(1, p)):
                    out.append((start, length, p))
                start = None
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_periods(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    dropped = {i for s, n, p in found for i in range(s + p, s + n)}
    top = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None,) * 3
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


RUN_COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def repetitive(n=150, seed=9):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words, letters = [], rng.choice([1, 2, 3, 40])
        for _ in range(rng.randint(1, 12)):
            unit = [f"w{rng.randrange(letters)}" for _ in range(rng.randint(1, 25))]
            words += (unit * rng.randint(1, 9))[: rng.randint(1, 150)]
        rows.append((5000 + i, rng.choice([" ", "\n", "\t "]).join(words)))
    return rows


@pytest.mark.parametrize("tile_words", [periods.TILE_WORDS, 16, 64])
def test_periods(spark, tile_words):
    rows = [r for r in AWKWARD if not r[1] or len(r[1]) < 9000] + repetitive() + prose(60) + [(7001, "a " * 700), (7002, "a b " * 400 + "c " + "a b " * 300)]
    got = [tuple(r[c] for c in RUN_COLUMNS) for r in rows_of(periods.digests(documents(spark, rows), tile_words))]
    assert key(got) == key([brute_periods(*r) for r in rows])


def test_runs_as_rows(spark):
    rows = repetitive(40, 4)
    got = [(r["doc_id"], r["start"], r["length"], r["period"]) for r in rows_of(periods.runs(documents(spark, rows), 32))]
    assert sorted(got) == sorted((d, *r) for d, t in rows for r in brute_runs(WORD.findall(t)))


def test_tiles_hold_three_periods():
    for n, tile in [(3, 16), (100, 16), (5000, 64), (9000, 2048), (100_000, 2048)]:
        plan = periods.tile_plan(n, tile)
        for k in range((n // 4).bit_length()):
            mine = [(s, e) for s, e, low, high in plan if low <= k <= high]
            assert mine[0][0] == 0 and mine[-1][1] == n
            assert all(e - s2 >= 5 << k for (_, e), (s2, _) in zip(mine, mine[1:]))


def test_hash_collisions_are_found_out(monkeypatch):
    """Hashes that call everything equal for the first base are noticed by the comparison of words."""
    kept = periods._Hash.same
    monkeypatch.setattr(periods._Hash, "__init__", lambda self, words, seed, old=periods._Hash.__init__: (setattr(self, "seed", seed), old(self, words, seed))[1])
    monkeypatch.setattr(periods._Hash, "same", lambda self, x, y, n: (np.asarray(n) <= 4) if self.seed == 1 and np.ndim(n) else kept(self, x, y, n))
    words = W.mix(np.array([1, 2, 3] * 6 + [4] * 9, np.uint64))
    found = periods.solve(words, np.array([0, len(words)]), np.array([0]), np.array([2]))
    found = found[:, periods.complete(*found[1:])]
    assert sorted(zip(found[2].tolist(), (found[3] + found[1] - found[2]).tolist(), found[1].tolist())) == [(0, 18, 3), (18, 9, 1)]


def test_periods_of_no_rows(spark):
    assert rows_of(periods.digests(documents(spark, []))) == []


def test_very_long_repetitive_text(spark):
    text = "tick tock " * 60_000 + "end " + "x " * 50_000
    got = rows_of(periods.runs(documents(spark, [(1, text)])))
    assert sorted((r["start"], r["length"], r["period"]) for r in got) == [(0, 120_000, 2), (120_001, 50_000, 1)]


# ------------------------------------------------------------------ WARC
PAGES = [(1, "http://a.example/x", "<p>one</p>"), (2, "http://a.example/y z", "<p>two</p>"), (3, None, None), (4, "http://b/\r\nWARC-Type: x", ""),
         (5, "http://ä/日本", "<p>one</p>"), (6, "u", "body\r\n\r\nWARC/1.1\r\n\r\n"), (None, "n", "<p>one</p>"), (None, "n", "alone"),
         (2, "http://a.example/y z", "<p>two</p>"), (9, "big", "naïve 日本 " * 20000)] + [(100 + i, f"http://c/{i}", f"<html>page {i % 40} " + "text " * 30) for i in range(200)]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "en", 3) for r in rows], "page_id long, url string, html string, record_type string, first long").repartition(3)


def brute_warc(rows, least=0):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data, f = (h or "").encode(), first.get(h or "")
        revisit = f is not None and f != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", f if revisit else None))
    return out


@pytest.mark.parametrize("least", [0, 100])
def test_warc_round_trip(spark, least):
    got = [tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in rows_of(warc.round_trip(pages(spark, PAGES), least))]
    assert key(got) == key(brute_warc(PAGES, least))


def test_warc_payloads_and_files(spark, tmp_path):
    manifest = rows_of(warc.write_archives(pages(spark, PAGES), str(tmp_path), archive_bytes=2000))
    assert len(manifest) > 3 and sum(r["records"] for r in manifest) == len(PAGES)
    (tmp_path / "archives" / "stray.warc.zst").write_bytes(b"left by a lost task")  # in no manifest
    got = rows_of(warc.read_archives(spark, str(tmp_path)))
    assert all(r["problem"] is None for r in got)
    assert sum(r["record_type"] == "warcinfo" for r in got) == len(manifest)
    kept = {r["record_id"]: bytes(r["payload"]) for r in got if r["record_type"] == "response"}
    for i, _, h in PAGES:
        if i is not None and f"urn:page:{i}" in kept:
            assert kept[f"urn:page:{i}"] == (h or "").encode()
    assert {r["target_uri"] for r in got if r["record_id"] == "urn:page:4"} == {"http://b/%0D%0AWARC-Type:%20x"}


def archive(records, dictionary=b"", raw=False, **how):
    import zstandard
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    packer = zstandard.ZstdCompressor(dict_data=held, **how)
    lead = (warc.struct.pack("<II", warc.DICTIONARY_MAGIC, len(dictionary)) + dictionary if raw else warc.dictionary_frame(dictionary)) if dictionary else b""
    return lead + b"".join(packer.compress(r) for r in records)


GOOD = warc.page_record(7, "http://x", b"hello", warc.digest(b"hello"), 5, None, False, warc.DATE)


@pytest.mark.parametrize("raw", [True, False])
@pytest.mark.parametrize("size", [True, False])
def test_dictionary_frames(raw, size):
    import zstandard
    samples = [b"<html>page %d some text that repeats %d</html>" % (i, i * 7) for i in range(500)]
    dictionary = zstandard.train_dictionary(2000, samples).as_bytes()
    data = archive([GOOD, warc.page_record(8, "http://x", b"", warc.digest(b"hello"), 5, 7, True, warc.DATE)], dictionary, raw, write_content_size=size, write_checksum=size)
    got = list(warc.read_archive(data))
    assert [(r.get("problem"), r["record_type"], r["payload_bytes"], r.get("refers_to")) for r in got] == [(None, "response", 5, None), (None, "revisit", 5, "urn:page:7")]
    assert sum(r["frame_bytes"] for r in got) + got[0]["offset"] == len(data)


@pytest.mark.parametrize("change,problem", [
    (lambda d: d.replace(b"WARC/1.1", b"WARC/9.9"), "unknown version"),
    (lambda d: d.replace(b"WARC-Date: 1970", b"WARC-Date: x"), "malformed WARC-Date"),
    (lambda d: d.replace(b"WARC-Type: response\r\n", b""), "no field warc-type"),
    (lambda d: d.replace(b"WARC-Type: response", b"WARC-Type: response\r\nWARC-Type: response"), "repeated field warc-type"),
    (lambda d: d.replace(b"hello", b"hallo"), "block digest differs"),
    (lambda d: d.replace(b"hello", b"hello!"), "Content-Length does not meet the end of the block"),
    (lambda d: d + GOOD, "more than one record in a frame"),
    (lambda d: d[:-3], "Content-Length does not meet the end of the block"),
    (lambda d: d.replace(b"\r\n\r\nHTTP", b"\r\nbad line\r\n\r\nHTTP"), "malformed header line"),
    (lambda d: d.replace(b"<urn:page:7>", b"urn:page:7"), "malformed WARC-Record-ID"),
    (lambda d: d.replace(b"Content-Length: ", b"Content-Length: -"), "Content-Length is not a number"),
    (lambda d: b"\xff" + d, "header is not UTF-8"),
    (lambda d: b"no header", "no end of the record header"),
])
def test_bad_records_are_told(change, problem):
    got = list(warc.read_archive(archive([change(GOOD), GOOD])))
    assert got[0]["problem"] == problem and "problem" not in got[1] and got[1]["payload"] == b"hello"


def test_bad_payload_digest_and_length():
    wrong = warc.page_record(7, "http://x", b"hello", warc.digest(b"other"), 5, None, False, warc.DATE)
    short = warc.page_record(7, "http://x", b"hello", warc.digest(b"hello"), 4, None, False, warc.DATE)
    assert [r["problem"] for r in warc.read_archive(archive([wrong, short]))] == ["payload digest differs", "HTTP Content-Length differs from the payload"]


def test_damaged_frames_end_the_archive():
    data = archive([GOOD, GOOD])
    assert [r.get("problem") for r in warc.read_archive(data[:-4])] == [None, "truncated frame"]
    assert [r.get("problem") for r in warc.read_archive(data + b"garbage!")] == [None, None, "not a Zstandard frame"]
    assert [r.get("problem") for r in warc.read_archive(b"\x5d\x2a\x4d\x18\xff\xff\x00\x00")] == ["truncated skippable frame"]
    checked = archive([GOOD], write_checksum=True)
    assert list(warc.read_archive(checked[:-1] + bytes([checked[-1] ^ 1])))[0]["problem"].startswith("frame:")
    assert list(warc.read_archive(b"")) == []


def test_unresolved_revisits(spark):
    rows = [("urn:page:1", "response", "D", 5, None, None), ("urn:page:2", "revisit", "D", 5, "urn:page:1", None),
            ("urn:page:3", "revisit", "E", 5, "urn:page:1", None), ("urn:page:4", "revisit", "D", 5, "urn:page:9", None)]
    df = spark.createDataFrame(rows, "record_id string, record_type string, payload_digest string, payload_bytes long, refers_to string, problem string")
    assert sorted(r["record_id"] for r in rows_of(warc.unresolved(df))) == ["urn:page:1", "urn:page:9"]


def test_no_pages(spark):
    assert rows_of(warc.round_trip(pages(spark, []))) == []


@pytest.mark.parametrize("name", ["op11_cross_tokenizer_alignment", "op12_periodic_runs"])
def test_registered_queries(spark, name):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = rows_of(Q.REGISTRY[name](spark, SF))
    if name.startswith("op11"):
        assert key(tuple(r[c] for c in COLUMNS) for r in got) == key(brute_alignment(rows))
    else:
        assert key(tuple(r[c] for c in RUN_COLUMNS) for r in got if r["n_runs"] or True) == key(brute_periods(*r) for r in rows)
