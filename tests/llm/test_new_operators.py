"""Hard negatives, prefix trie and packing: edge cases, skew, and results by their definitions."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from brute import sha
from pyspark.sql import functions as F

from trustline.llm.negatives import fit, index, mine, shelves
from trustline.llm.packing import LATIN, Packer, pack, pack_documents, parts, pieces, sequences, token_ids, tokenizer, words
from trustline.llm.queries import QUERIES
from trustline.llm.trie import prefix_trie

WORDS = public_tokenizers.path("word_bpe_49k.json")
VECTORS = "vec_id long, embedding array<float>, label int, v binary, leaf string, block int"
TURNS = "conv_id long, turn long, role string, text string, position string, x int"
DOCS = "doc_id long, text string, at long, piece string, length string"


# Hard negatives


def hard_negatives(rows, positives=5, negatives=3):
    """By definition, one anchor at a time."""
    own = []
    for ident, vector, label in rows:
        if label is None or vector is None or not all(x is not None and np.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if ident is not None and ident % 7 == 0 else label
        own.append((ident, [int(np.floor(256 * np.float64(np.float32(x)))) for x in vector], label))
    last = lambda i: (own[i][0] is None, own[i][0] or 0)
    out = []
    for a, (ident, v, label) in enumerate(own):
        if ident is None or ident % 50:
            continue
        score = [sum(x * y for x, y in zip(v, w)) for _, w, _ in own]
        near = sorted((i for i in range(len(own)) if i != a and own[i][2] == label), key=lambda i: (-score[i], last(i)))[:positives]
        for p in near:
            fits = [i for i in range(len(own)) if own[i][2] != label and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            for rank, i in enumerate(sorted(fits, key=lambda i: (-score[i], last(i)))[:negatives], 1):
                out.append((ident, own[p][0], rank, own[i][0], score[p], score[i]))
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(i, v, lab, b"", "", 0) for i, v, lab in rows], VECTORS)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, mine(df, F.col("vec_id") % 50 == 0, label=label, **options).collect()), key=repr)


def vectors(n, dims=4, seed=1, spread=1.0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, dims))
    return [(i, (centres[i % 6] + spread * draw.normal(size=dims)).astype(np.float32).tolist(), int(draw.integers(0, 3))) for i in range(n)]


def test_hard_negatives_of_edge_cases(spark):
    rows = vectors(220)
    rows += [(None, rows[3][1], 1), (50, rows[50][1], rows[50][2]), (50, rows[50][1], rows[50][2])]  # no id, repeated anchor
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5], i % 2) for i in range(60)]  # a hot vector
    rows += [(300, None, 1), (350, [float("nan"), 0.0, 0.0, 0.0], 1), (400, [None, 1.0, 1.0, 1.0], 1), (450, [1.0] * 4, None), (500, [float("inf")] * 4, 2)]
    rows += [(550, [], 1), (600, [1.5], 2), (650, [-3.0] * 4, 0), (700, [300.0] * 4, 1)]
    assert mined(spark, rows, block=16, sample=64) == hard_negatives(rows)


@pytest.mark.parametrize("sample", [4, 100, 10_000])
def test_any_sample_gives_the_same_hard_negatives(spark, sample):
    rows = vectors(400, dims=3, seed=2, spread=0.2)
    assert mined(spark, rows, sample=sample, block=50) == hard_negatives(rows)


def test_hard_negatives_of_no_rows(spark):
    assert mined(spark, []) == [] and mined(spark, [(50, None, 1)]) == [] and mined(spark, [(50, [1.0], 1)]) == []
    with pytest.raises(OverflowError):
        mined(spark, [(50, [1e9], 1), (51, [1e9], 1)])


def test_ranges_eliminate_siblings(spark):
    rows = vectors(3000, dims=3, seed=3, spread=0.02)
    df = spark.createDataFrame(rows, "id long, vector array<float>, label long").withColumn("anchor", F.lit(False))
    found = index(df, 256, 400, 64)
    assert found.tree.leaves > 8 and found.rows.count() == 3000
    anchors = np.column_stack([np.array([r[1] for r in rows[:50]]) * 256 // 1, np.zeros(50)])
    square = (anchors**2).sum(axis=1)[:, None] + found.scale.norm**2
    near, far = np.zeros((50, 1)), np.sqrt(square - 2 * 0.999 * square / 2 * 1.0)
    left = found.remaining(anchors, near, np.minimum(far, 60))
    assert sum(map(len, left)) < 0.5 * 50 * found.tree.leaves


def test_a_hot_vector_is_one_leaf_in_many_blocks():
    tree = fit(np.vstack([np.ones((500, 3)), np.eye(3)]))
    assert tree.leaves == 1 or tree.leaf_of(np.ones((4, 3))).tolist() == [tree.leaf_of(np.ones((1, 3)))[0]] * 4
    shelf, blocks = shelves([3, 4, 1000, 2, 0, 5], 8)
    assert shelf.tolist() == [0, 0, 1, 2, 2, 2] and blocks.tolist() == [1, 125, 1]


# Prefix trie


def trie(rows):
    """By definition: {(members' smallest, depth): row}"""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(turns.get(c - int(np.fmod(c, 5)), [])[:h] + own[h:])
    members = defaultdict(list)
    for c, own in built.items():
        for d in range(len(own) + 1):
            members[own[:d]].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + ((len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0)
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k], sha(",".join(map(str, sorted(c for c in m if built[c] == k)))))
        for k, m in members.items()
    )


def tries(spark, rows, **options):
    df = spark.createDataFrame([(*r, "", 0) for r in rows], TURNS)
    return sorted(map(tuple, prefix_trie(df, **options).collect()), key=lambda r: (r[0], r[1]))


def test_trie_of_edge_cases(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "bot", f"turn {t} of {c // 10 if t < c % 4 else c}") for c in range(-12, 40) for t in range(c % 7)]
    rows += [(None, 0, "user", "lost"), (7, None, None, None), (8, 3, "", ""), (9, 3, None, "é"), (9, 3, None, "é"), (3, None, "a", "first")]
    rows += [(100 + c, 0, "s", "hot") for c in range(40)] + [(100 + c, 1 + t, "s", "hot") for c in range(0, 40, 3) for t in range(12)]
    assert tries(spark, rows) == sorted(trie(rows), key=lambda r: (r[0], r[1]))


def test_trie_of_long_conversations(spark):
    draw = np.random.default_rng(5)
    rows = [(5 * c, t, "u", "same" if t < cut else str(draw.integers(0, 2))) for c in range(12) for cut in [int(draw.integers(0, 150))] for t in range(int(draw.integers(cut, 170)))]
    rows += [(5 * c, t, "u", "same") for c in range(20, 26) for t in range(9 * c - 100)]
    assert tries(spark, rows, chunk=16, fan=4) == sorted(trie(rows), key=lambda r: (r[0], r[1]))


def test_trie_without_turns(spark):
    assert tries(spark, []) == [] and tries(spark, [(None, 1, "u", "x")]) == []
    # The shared part of an absent family head is empty and swallows the only turn.
    alone = next(c for c in range(1, 100, 5) if zlib.crc32(str(c).encode()) % 9 > 0)
    assert tries(spark, [(alone, 0, "u", "x")]) == [(alone, 0, None, 1, 0, 1, 0, sha(str(alone)))]


# Packing


def library(text):
    return tokenizer(WORDS).encode(text or "", add_special_tokens=False).ids


def with_end(text):
    return np.array([*library(text), 0], "<u4")


def ids_of(text, **options):
    return np.frombuffer(token_ids(WORDS, text.encode(), **options), "<u4").tolist()


def test_ids_of_words_are_the_librarys():
    letters = [chr(c) for c in range(0x250) if re.fullmatch(f"[\x21-\x7e{LATIN}]", chr(c))]
    for text in [*letters, *(f"x{c}y{c}" for c in letters), *(f"{c}'s{c}'" for c in letters), " ".join(letters), "".join(letters)]:
        assert ids_of(text) == library(text), text
    rng = random.Random(3)
    alphabet = [*"aeinoÉßſǅst  \n\t.,!?'19é漢 \u0085\u00a0\x1c\u0301\u0130Σς", "'ll", "ing", "The", "<|endoftext|>", "<|", "|>", "\u1100\u1161", "\x0b", "\u3000"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
        assert ids_of(text) == library(text), repr(text)
    assert words(WORDS).splits and not words(public_tokenizers.path("byte_bpe_50k.json")).splits


def test_pieces_are_the_librarys_ids(spark):
    texts = ["", None, "Ein Wort", "a " * 3000, "Σίσυφος ΣΑΣ ﬁ é  x　y", "<|endoftext|> <|startoftext|>x", "x" * 5000, "line\r\n\ttab z"] * 2
    docs = spark.createDataFrame([(None if i == 3 else i, t, 0, "", "") for i, t in enumerate(texts)], DOCS)
    rows = pack_documents(docs, WORDS, size=64, keep_ids=True).collect()
    plain = [with_end(t) for t in texts]
    held = defaultdict(list)
    for r in rows:
        own = plain[3 if r.id is None else r.id][r.start : r.start + 64].tobytes()
        assert r.start == 64 * r.piece and r.ids == own and r.ids_crc32 == zlib.crc32(own) and 4 * r.length == len(own)
        held[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(map(len, plain))
    for own in held.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1].tolist()] and ends[-1] <= 64
    assert len(held) <= -(-sum(map(len, plain)) // 64) + 3


def test_long_texts_are_encoded_in_parts():
    text = " ".join(["Word", "naïve", "x" * 70, "<|endoftext|>", "é", "\n\n", "12'll"] * 40)
    assert b"".join(parts(text.encode(), 50)).decode() == text and len(list(parts(text.encode(), 50))) > 20
    assert ids_of(text, long=50) == library(text)


def best_fit(lengths, size, most):
    """Bounded-space best fit by definition: all open bins looked through."""
    bins, opened, out = [], 0, []
    for n in lengths:
        fits = [b for b in bins if size - b[1] >= n]
        if fits:
            own = min(fits, key=lambda b: size - b[1])
        else:
            if len(bins) == most:
                bins.remove(max(bins, key=lambda b: b[1]))
            own = [opened, 0]
            opened += 1
            bins.append(own)
        out.append(size - own[1])
        own[1] += n
        bins = [b for b in bins if b[1] < size]
    return opened, out


@pytest.mark.parametrize("most", [1, 3, 50])
def test_packer_is_best_fit(most):
    lengths = np.random.default_rng(most).integers(1, 101, 2000).tolist()
    packer = Packer(100, most)
    placed = [100 - packer.place(n)[1] for n in lengths]
    assert (packer.opened, placed) == best_fit(lengths, 100, most)
    assert packer.n_open == sum(map(len, packer.bins.values())) <= most


def test_packed_sequences_hold_their_parts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = pieces(docs, WORDS, keep_ids=True)
    packed = pack(found, packer=32).persist()
    whole = {r.sequence_id: r for r in sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id].ids[4 * r.offset : 4 * (r.offset + r.length)] == r.ids
    assert sum(len(r.ids) for r in whole.values()) == 4 * found.agg(F.sum("length")).first()[0]
    packed.unpersist()


def test_registered_packing_of_the_whole_table(spark, sf):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    plain = {i: with_end(text) for i, text in texts.items()}
    rows = QUERIES["op13_bestfit_packing"](spark, sf).collect()
    expected = sorted((i, k, 2048 * k, len(own[2048 * k : 2048 * (k + 1)]), zlib.crc32(own[2048 * k : 2048 * (k + 1)].tobytes())) for i, own in plain.items() for k in range(-(-len(own) // 2048)))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for own in held.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048
    assert len(held) <= 1.02 * -(-sum(map(len, plain.values())) // 2048)


def test_packing_of_no_rows(spark):
    assert pack_documents(spark.createDataFrame([], DOCS), WORDS).collect() == []


# Token counts from stored prefix counts


def test_registered_token_counts_are_the_librarys_and_come_from_the_stored_counts(spark, sf, monkeypatch):
    from tokenizers import Tokenizer

    from trustline.llm import tokens

    whole, asked = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), []
    monkeypatch.setattr(tokens, "within", lambda counts, budget, own=tokens.within: asked.append(counts.columns) or own(counts, budget))
    rows = {r.doc_id: r for r in QUERIES["op6_token_counts"](spark, sf).collect()}
    assert asked == [["id", "n_bytes", "changes"]]
    for doc in spark.read.parquet(f"{sf}/documents.parquet").collect():
        text = doc.text or ""
        n = len(whole.encode(text, add_special_tokens=False).ids)
        row = rows.pop(doc.doc_id)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 1024)
        text.encode()[: row.fitting_bytes].decode()
        assert (row.fitting_bytes == row.n_bytes) == (n <= 1024)
    assert not rows


def test_no_answer_ends_within_a_character():
    from trustline.llm import tokens

    vocab = tokens.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    text = "é漢😀 naïve 漢漢漢 <|endoftext|>é"
    changes = vocab.changes(text)
    assert len(changes) == len(text.encode())
    for budget in range(40):
        text.encode()[: tokens.longest_within(changes, budget)].decode()
    for end in range(len(text) + 1):
        cut = len(text[:end].encode())
        assert tokens.count_within(changes, cut) >= 0 and tokens.longest_within(changes, tokens.count_within(changes, cut)) >= cut


def test_tokens_side_by_side_are_judged_as_by_merging_them():
    from trustline.llm import tokens

    vocab = tokens.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(9)
    whole = [t for t in sorted(vocab.tokens) if vocab.merge(t) == [t]]
    short = [t for t in whole if len(t) < 5]
    seen = {True: 0, False: 0}
    for _ in range(20_000):
        a, b = rng.choice(short if rng.random() < 0.7 else whole), rng.choice(short if rng.random() < 0.7 else whole)
        fits = (a, b) not in vocab.rank and vocab.merge(a + b) == [a, b]
        assert vocab.apart(a, b) == fits, (a, b)
        seen[fits] += 1
    for token in rng.sample(whole, 3000):
        cut = rng.randrange(1, len(token)) if len(token) > 1 else 0
        a, b = token[:cut], token[cut:]
        if cut and a in vocab.tokens and b in vocab.tokens and vocab.merge(a) == [a] and vocab.merge(b) == [b]:
            assert not vocab.apart(a, b)
            seen[False] += 1
    assert min(seen.values()) > 500
