"""Source divergence, BPE round trip and Merkle manifest against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import divergence, merkle, word_bpe


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# op11


def expected_divergence(rows, least=3, shown=200):
    """lang, source, part, item, value, rank by the definition: every kept word of every group, zeros included."""
    groups, df, n = set(), defaultdict(Counter), defaultdict(Counter)
    for row in rows:
        text, lang, source = (row[k] or "" for k in (1, 2, 3))
        found = [lowered(t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        groups.add((lang, source))
        n[lang, source].update(found)
        df[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, k in df[lang].items() if k >= least]
        own = {s: {t: n[lang, s][t] for t in kept} for la, s in groups if la == lang}
        own[None] = {t: sum(c[t] for c in own.values()) for t in kept}
        p = {s: {t: 1 + 10**9 * (k + 1) // (sum(c.values()) + len(kept)) for t, k in c.items()} for s, c in own.items()}
        gap = lambda a, b: (a - b) ** 2 // b
        for s in own.keys() - {None}:
            pairs = [(o, sum(gap(p[s][t], p[o][t]) for t in kept)) for o in own if o not in (None, s)]
            telling = [(t, gap(p[s][t], p[None][t])) for t in kept if own[s][t] and p[s][t] > p[None][t]]
            for part, found, most in (("pair", pairs, None), ("term", telling, shown)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return Counter(out)


@pytest.mark.parametrize("width", [1 << 20, 64])  # in the small table nearly every rare word passes
def test_divergence_is_exact(docs, rows, width):
    more = [(7, "É straße Straße x_y 1a naïve", "xx", "s1", 1, ""), (8, "STRASSE É É", "xx", None, 1, ""), (9, "", "xx", "empty", 0, ""), (10, "only", "solo", "one", 4, "")]
    every = rows + more * 2
    df = docs.sparkSession.createDataFrame(every, docs.schema).repartition(3).drop("taken").withColumns({"term": F.lit(1), "n": F.lit("x")})
    got = divergence.audit(df, width=width, shown=5)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, got.collect())) == expected_divergence(every, shown=5)


def test_divergence_of_an_empty_table_and_without_kept_words(spark, no_docs):
    assert divergence.audit(no_docs).count() == 0
    df = spark.createDataFrame([("a", "s", "one two"), ("a", "t", None), ("a", None, "three")], "lang string, source string, text string")
    assert sorted(map(tuple, divergence.audit(df, width=1 << 12).collect())) == [
        ("a", "", "pair", "s", 0, 1), ("a", "", "pair", "t", 0, 2), ("a", "s", "pair", "", 0, 1), ("a", "s", "pair", "t", 0, 2), ("a", "t", "pair", "", 0, 1), ("a", "t", "pair", "s", 0, 2)]


def test_sketch_never_underestimates_and_discards_rare_words(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=40)) for _ in range(400)]
    df = spark.createDataFrame([("en", "s", t) for t in texts], "lang string, source string, text string").repartition(4)
    real = Counter(w for t in texts for w in set(t.split(" ")))
    got = {r["term"]: r["df"] for r in divergence.counts(df, divergence.sketch(df, width=1 << 14)).collect() if r["term"]}
    assert {w: k for w, k in real.items() if k >= 3}.items() <= got.items()
    assert sum(k < 3 for k in got.values()) < 0.02 * sum(k < 3 for k in real.values())


def test_frequencies_are_exact_beyond_64_bits(spark):
    n, total, kept = 10**13, 10**16 + 7, 10**9
    df = spark.createDataFrame([(n, total, kept)], "n long, total long, kept long")
    assert df.select(divergence.frequency(F.col("n"), F.col("total"), F.col("kept"))).first()[0] == 1 + 10**9 * (n + 1) // (total + kept)


# op12


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(word_bpe.vocabulary_path())
    out.no_truncation()
    out.no_padding()
    return out


def test_words_are_encoded_as_the_library_does(library):
    rng, encoder = random.Random(1), word_bpe.Encoder(word_bpe.vocabulary_path())
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFéüñßИжあ漢🎉 \t\n\r\x0b\x1c\u0085  '’.,!?-_</w>|0123456789́İΣσς‍"
    for k in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        if k % 5 == 0:
            text = f"{text[:10]}<|endoftext|>{text[10:]}<|startoftext|>"
        elif k % 5 == 1:
            text = "".join(rng.choice("aeinrstlh") for _ in range(30))
        elif k % 5 == 2:
            text = rng.choice("aeo!-.é") * rng.randint(1, 70)
        assert encoder(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_every_token_is_made_of_its_own_characters_or_never(library):
    """The last token of a prefix is unique: each token that the automaton holds encodes to itself, the others to something else."""
    vocabulary = word_bpe.Vocabulary(word_bpe.vocabulary_path())
    held = {i for _, i in vocabulary.automaton.values()}
    ending = [(t, i) for t, i in vocabulary.ids.items() if t.endswith(vocabulary.suffix)]
    assert all((vocabulary.word(t.removesuffix(vocabulary.suffix)) == [i]) == (i in held) for t, i in ending)


def test_round_trip_of_documents(docs, rows, library):
    path = word_bpe.vocabulary_path()
    long = [(2000, "a" * 5000 + " " + "long text, " * 20_000, "en", "s1", 1, ""), (2001, "<|endoftext|>x <|endoftext|>", "en", "s1", 1, "")]
    every = rows + long
    df = docs.sparkSession.createDataFrame(every, docs.schema).withColumn("ids", F.lit(1)).repartition(3)
    got = Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["text"]) for r in word_bpe.decode(word_bpe.encode(df, path), path).collect())
    want = Counter()
    for row in every:
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        want[row[0], len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)] += 1
    assert got == want


def test_round_trip_of_an_empty_table(no_docs):
    path = word_bpe.vocabulary_path()
    assert word_bpe.decode(word_bpe.encode(no_docs, path), path).count() == 0


# op13


def joined(digests):
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([joined(out[-1][k : k + fanout]) for k in range(0, len(out[-1]), fanout)])
    return out


def leaf(row):
    return joined(["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def expected_proofs(rows, fanout=16):
    """rows: doc_id, source, lang, n_chars, text."""
    by = defaultdict(list)
    for row in rows:
        by[row[1]].append(row)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels([d for *_, d, _ in own], fanout) for own in (sorted((r[0] is not None, r[0] or 0, leaf(r), k) for k, r in enumerate(by[s])) for s in names)]
    crown, out = levels([t[-1][0] for t in trees], fanout), []
    for place, s in enumerate(names):
        own = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        for i, row in enumerate(own):
            spoilt = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            at = leaf((*row[:4], lowered(row[4]))) if spoilt and row[4] is not None else leaf(row)
            siblings = []
            for way, k in ((trees[place], i), (crown, place)):
                for level in way[:-1]:
                    run = level[k // fanout * fanout :][:fanout]
                    k, x = k // fanout, k % fanout
                    siblings += run[:x] + run[x + 1 :]
                    at = joined([*run[:x], at, *run[x + 1 :]])
            root = crown[-1][0]
            out.append((row[0], leaf(row), trees[place][-1][0], root, joined(siblings), at, at == root))
    return Counter(out)


def proofs_of(df, fanout=16):
    c, own = F.col, [F.col(k) for k in merkle.COLUMNS]
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    mate = F.when(F.crc32(c("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.leaf([*own[:-1], low]))
    leaves = df.select(merkle.tree_of(c("source")).alias("tree"), c("doc_id"), merkle.leaf(own).alias("digest"), mate.alias("mate"))
    return merkle.proofs(*merkle.manifest(leaves, fanout), fanout)


def test_manifest_of_documents_with_nulls_and_repeats(docs, rows):
    got = proofs_of(docs.withColumns({"level": F.lit(1), "digest": F.lit("x")}))
    assert Counter(map(tuple, got.collect())) == expected_proofs([(r[0], r[3], r[2], r[4], r[1]) for r in rows])


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_manifest_across_unaligned_partitions(spark, fanout):
    """A source of most rows lies in several partitions; others have one row, a full run, and one row more than a full run."""
    rows = [(k, "hot", "en", k % 7, f"Text {k}") for k in range(431)] + [(1000 + k, f"s{k:02}", "fr", k, "É") for k in range(18)]
    rows += [(k, "full", None, None, "A") for k in range(16)] + [(k, "more", "en", 1, None) for k in range(17)] + [(5, None, "en", 1, ""), (None, None, "en", 1, "Null id"), (5, "", "en", 1, "empty name")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert Counter(map(tuple, proofs_of(df, fanout).collect())) == expected_proofs(rows, fanout)


def test_manifest_of_one_row_and_of_none(spark, no_docs):
    row = (5, "s", "en", 4, "Text")
    df = spark.createDataFrame([row], "doc_id long, source string, lang string, n_chars long, text string")
    assert Counter(map(tuple, proofs_of(df).collect())) == expected_proofs([row])
    assert proofs_of(no_docs).count() == 0


def test_stack_emits_every_node_once_and_leaves_edges_open():
    seen = []
    stack = merkle.Mountains(4, lambda level, first, run, is_open: seen.extend((level, first + k, n[0], is_open) for k, n in enumerate(run)))
    leaves = [hashlib.sha256(str(k).encode()).hexdigest() for k in range(64)]
    for k in range(3, 41):
        stack.add(k, (leaves[k], k, None))
    stack.close()
    want = levels(leaves, 4)
    assert all(want[level][k] == d for level, k, d, _ in seen) and len({x[:2] for x in seen}) == len(seen)
    assert sorted(x[:2] for x in seen if x[3]) == [(0, 3), (0, 40), (1, 1), (1, 2), (1, 3), (1, 8), (1, 9), (2, 1)]
