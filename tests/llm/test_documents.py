"""Document operators against brute force on a small corpus with hard cases."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerloom.llm import bwt_dedup, mixing, near_dedup, packing, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 1 << 63


def order_of(row):
    return LAST if row[0] is None else row[0]


def earliest(rows, windows):
    """Smallest id of each window over all documents."""
    first = {}
    for row in rows:
        for w in windows(row[1] or ""):
            first[w] = min(first.get(w, LAST), order_of(row))
    return first


def expected_bytes(rows, n=50):
    windows = lambda t: [t.encode()[k : k + n] for k in range(len(t.encode()) - n + 1)]
    first, out = earliest(rows, windows), []
    for row in rows:
        data = (row[1] or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for k, w in enumerate(windows(row[1] or "")):
            if first[w] < order_of(row):
                gone[k : k + n] = True
        runs = int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()) if len(data) else 0
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        out.append((row[0], len(data), int(gone[:-1].sum()), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def expected_words(rows, n=13):
    windows = lambda t: [tuple(WORD.findall(t)[k : k + n]) for k in range(len(WORD.findall(t)) - n + 1)]
    first, out = earliest(rows, windows), []
    for row in rows:
        words = WORD.findall(row[1] or "")
        gone = [False] * len(words)
        for k, w in enumerate(windows(row[1] or "")):
            if first[w] < order_of(row):
                gone[k : k + n] = [True] * n
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((row[0], len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def test_repeated_bytes(docs, rows, no_docs):
    got = bwt_dedup.remove_repeats(docs).collect()
    assert Counter(tuple(r) for r in got) == expected_bytes(rows)
    assert sum(r["n_removed"] for r in got) > 0
    assert bwt_dedup.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("hot", [1])
@pytest.mark.parametrize("operator, expected", [(bwt_dedup, expected_bytes), (substring_dedup, expected_words)])
def test_windows_of_hot_anchors_travel_one_by_one(docs, rows, monkeypatch, operator, expected, hot):
    from ledgerloom.llm import anchors

    monkeypatch.setattr(anchors, "BUCKET", 2_000)  # many buckets of few documents
    got = operator.remove_repeats(docs, hot=hot).collect()
    assert Counter(tuple(r) for r in got) == expected(rows)


def test_few_and_short_texts(spark):
    rows = [(1, "a b c"), (2, "a b c"), (3, ""), (4, "x")]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in bwt_dedup.remove_repeats(made).collect()) == expected_bytes(rows)
    assert Counter(tuple(r) for r in substring_dedup.remove_repeats(made).collect()) == expected_words(rows)


def test_a_passage_of_all_documents(spark, monkeypatch):
    from ledgerloom.llm import anchors

    passage = "terms of use apply to every page of this site, see the notice at its end and our policy on reuse"
    rows = [(k, f"own {k * 7919} {passage} then {k * 104729} more words follow here than before {k}") for k in range(300)]
    made = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(anchors, "BUCKET", 3_000)
    for operator, expected in ((bwt_dedup, expected_bytes), (substring_dedup, expected_words)):
        for hot in (20, anchors.HOT):
            assert Counter(tuple(r) for r in operator.remove_repeats(made, hot=hot).collect()) == expected(rows)


def test_interleave_refinement_finds_equal_strings():
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(97, 99, rng.integers(10, 60)).astype(np.uint8)) for _ in range(60)] + [b"ab" * 20, b"ab" * 20]
    begins, block = bwt_dedup.repeated_intervals(texts, 10, shards=5)
    where, back = {}, {}
    for t, b in zip(texts, begins, strict=True):
        for k in range(len(t) - 9):
            assert where.setdefault(t[k : k + 10], block[b + k]) == block[b + k]
            assert back.setdefault(block[b + k], t[k : k + 10]) == t[k : k + 10]


def test_repeated_passages(docs, rows, no_docs):
    got = substring_dedup.remove_repeats(docs, with_text=True).collect()
    assert Counter(tuple(r)[:4] for r in got) == expected_words(rows)
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] for r in got)
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def test_repeated_passages_beside_a_very_long_word(spark):
    passage = " ".join(f"w{k}" for k in range(16))
    rows = [(k, f"{before} {passage} {'x' * 70_000} {passage[::-1]}") for k, before in ((1, "one"), (2, "two words"))]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).collect()
    assert Counter(tuple(r)[:4] for r in got) == expected_words(rows)
    assert {r["doc_id"]: r["kept"] for r in got}[2] == "two words"


def shingles(text, width):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))) if words else frozenset()


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, rows, no_docs, width):
    sets = defaultdict(list)
    for row in rows:
        if row[0] is not None:
            sets[row[0]].append(shingles(row[1], width))
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                i, j = sorted((find(a), find(b)))
                root[j] = i
    got = near_dedup.near_duplicates(docs, width=width).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == (None if r["doc_id"] is None else find(r["doc_id"])) and r["kept"] == (r["doc_id"] == r["component_id"])
    assert {len(shingles(r[1], width)) for r in rows} == {r["n_shingles"] for r in got}
    if width == 2:
        assert near_dedup.near_duplicates(no_docs).count() == 0


def test_mixing(docs, rows, no_docs):
    got = mixing.mix(docs, block=16)[0].collect()
    again = mixing.mix(docs, block=16)[0].collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again)) and len(got) == len(rows)
    sizes = Counter()
    for row in rows:
        sizes[row[3]] += len(WORD.findall(row[1] or ""))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, full, total = {}, set(), 1.5 * sum(sizes.values())
    while True:  # reshare what the full sources leave
        rest = total - sum(2 * sizes[s] for s in full)
        target = {s: 2 * sizes[s] if s in full else rest * weight[s] / sum(weight[x] for x in names if x not in full) for s in names}
        more = {s for s in names if target[s] > 2 * sizes[s] + 1e-9}
        if not more:
            break
        full |= more
    source_of = {(r[0], len(WORD.findall(r[1] or ""))): r[3] for r in rows}
    taken = Counter()
    for r in got:
        s = source_of[r["doc_id"], r["size"]]
        assert abs(r["target"] - target[s]) < 1e-6 and r["source_size"] == sizes[s] and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 16 * 4 for s in names)
    assert mixing.mix(no_docs)[0].count() == 0


def test_schedule_takes_every_block_in_turn_and_keeps_the_proportions(docs, spark):
    rows = [(k, "w " * (40 + k % 7), f"s{k % 5 if k % 3 else 0}") for k in range(600)]
    for made in (docs, spark.createDataFrame(rows, "doc_id long, text string, source string")):
        documents, slots = mixing.mix(made, block=16)
        slots = sorted(slots.collect())
        want = {r["sid"]: r["words"] for r in documents.select("sid", "words").distinct().collect() if r["words"]}
        assert [r["slot"] for r in slots] == list(range(len(slots)))
        seen, words = Counter(), Counter()
        for n, r in enumerate(slots, 1):
            assert r["k"] == seen[r["sid"]]
            seen[r["sid"]] += 1
            words[r["sid"]] += r["words"]
            assert all(abs(seen[s] - n * w / sum(want.values())) <= 4 + len(want) for s, w in want.items())
        assert words == want


def test_documents_enter_the_mix_where_their_words_stand(spark):
    rows = [(k, "w " * (5 + 13 * k % 50), f"s{k % 2}") for k in range(60)]
    documents, slots = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block=16)
    taken = Counter()
    for r in mixing.occurrences(documents, slots, block=16).collect():
        taken[r["doc_id"]] += r["part"]
    assert taken == Counter({r["doc_id"]: r["taken"] for r in documents.collect() if r["taken"]})


def test_mixing_reaches_the_targets_of_small_sources(spark):
    sizes = {"a": [100, 29], "b": [300], "c": [20], "d": [5], "e": [1, 1], "f": [4000, 1]}
    rows = [(k, "w " * n, s) for k, (s, n) in enumerate((s, n) for s in sizes for n in sizes[s])]
    docs, slots = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    taken, target, of, per = Counter(), {}, {}, Counter()
    for r in docs.collect():
        taken[r["sid"]] += r["taken"]
        target[r["sid"]], of[r["sid"]] = r["target"], r["source_size"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert sorted(of.values()) == sorted(map(sum, sizes.values()))
    assert all(abs(taken[k] - target[k]) <= 0.5 for k in of) and abs(sum(taken.values()) - 1.5 * sum(of.values())) <= 3
    found = sorted(slots.collect())
    assert [r["slot"] for r in found] == list(range(len(found)))
    for r in found:
        per[r["sid"]] += r["words"]
        assert 0 < r["words"] <= 128
    assert per == taken


def test_packing(docs, rows, no_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    got = packing.pack(docs, capacity=64, with_ids=True).collect()
    whole, used = defaultdict(list), defaultdict(list)
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] <= 64
        used[r["sequence_id"]].append((r["offset"], r["length"]))
        whole[r["doc_id"]].append((r["piece"], r["start"], r["ids"]))
    for spans in used.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 64
    for row in rows:
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [2]
        parts = sorted(whole[row[0]])
        if row != rows[5]:
            assert [x for _, _, part in parts for x in part] == ids
            assert [s for _, s, _ in parts] == [sum(len(p) for _, _, p in parts[:k]) for k in range(len(parts))]
    total = sum(r["length"] for r in got)
    assert len(used) <= 1.03 * -(-total // 64) + 1
    assert packing.pack(no_docs).count() == 0


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    encode, tokenizer = packing.Encoder(packing.vocabulary_path()), Tokenizer.from_file(packing.vocabulary_path())
    odd = ["a  b", "a \n b", " x", "x ", "  ", "", "\n\n a\t b", "é  è  x 12 3's  ", "<|endoftext|> a", "a\x1c b \x1cc", "don't  we'll\r\n  z", "ab, cd. ef... 1. é!", "日本 語. x"]
    for t in odd * 2:
        assert np.frombuffer(encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_layout_uses_every_piece_once():
    rng = np.random.default_rng(1)
    for counts in (rng.integers(0, 5, 101), np.bincount([60] * 1000, minlength=101), np.zeros(101, int)):
        counts[0] = 0
        used = np.zeros(101, int)
        for inside, n in packing.layout(counts, 100):
            assert sum(inside) <= 100
            for x in inside:
                used[x] += n
        assert (used == counts).all()
