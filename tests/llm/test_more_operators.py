import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from brute import winnow as chosen
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trustline.llm import fingerprints, mixing, quality, tokens
from trustline.llm.chat import format_chats, prefix_hashes
from trustline.llm.fingerprints import compare_edits, fingerprint, likeness, winnow
from trustline.llm.html import Page, extract
from trustline.llm.order import encoder, list_sequences, permute, read_sequences, write_sequences
from trustline.llm.tokens import count_tokens, count_within, longest_within

JSON, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))
WEIRD = [None, "", " ", "\n\n x", "don't I'll 12 é漢字  　 \x1c end", "<|endoftext|>", "a<|endoftext|>  b", "zz" * 400, "thnt" * 300, "  \t\r\n  ", "́​😀 😀"]


# -- tokens -----------------------------------------------------------------------------------


def test_counts_are_the_librarys(spark):
    library = Tokenizer.from_file(JSON)
    rng = random.Random(5)
    alphabet = [*"aeinorst  \n\t.,!?'19é漢 \u0085", "ing", "the", "<|endoftext|>"]
    texts = WEIRD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(120))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_tokens", F.lit("x"))
    got = {r.id: r for r in count_tokens(docs, JSON, 20).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        t = t or ""
        raw, r = t.encode(), got[i]
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens) == (len(raw), n)
        assert count_within(r.changes, len(raw)) == n and len(r.changes) == len(raw)
        assert longest_within(r.changes, n) == len(raw)
        assert count_within(r.changes, r.fitting_bytes) <= 20
        raw[: r.fitting_bytes].decode()
    assert count_tokens(docs.limit(0), JSON, 20).collect() == []


def test_prefix_counts_are_those_of_encoding_each_prefix():
    vocab = tokens.vocabulary(JSON)
    rng = random.Random(6)
    for _ in range(40):
        piece = "".join(rng.choice(["th", "e", "ing", "on", "a", "é", " ", "xq"]) for _ in range(rng.randrange(1, 9))).encode()
        assert vocab.prefixes(piece) == [len(vocab.merge(piece[:i])) for i in range(len(piece) + 1)]


# -- training order ---------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000, 4097])
def test_slots_are_a_permutation(n):
    slots = permute(np.arange(n), n, 7)
    assert sorted(slots.tolist()) == list(range(n))
    assert n < 17 or not np.array_equal(slots, permute(np.arange(n), n, 8))


def test_sequences_round_trip(spark, tmp_path):
    texts = [*WEIRD, "word " * 3000, "repeat", "repeat"]
    docs = spark.createDataFrame([(i if i else None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, slot int").repartition(3)
    layout = write_sequences(docs, str(tmp_path / "out"), RANKS, length=64, shard_bytes=2000)
    rows = list_sequences(spark, layout).collect()
    assert sorted(r.slot for r in rows) == list(range(layout["sequences"]))
    assert len({r.shard for r in rows}) > 3
    place = {(r.shard, r.byte): r for r in rows}
    assert len(place) == len(rows)
    read = list(read_sequences(spark, layout))
    assert [len(ids) for _, ids in read] == [r.n_tokens for r in sorted(rows, key=lambda r: r.slot)]
    assert list(read_sequences(spark, layout, 20)) == read[20:]
    encoding, end = encoder(RANKS)
    by_doc = {}
    for r, (_, ids) in zip(sorted(rows, key=lambda r: r.slot), read, strict=True):
        by_doc.setdefault(r.doc_id, {})[r.sequence] = ids
    for i, t in enumerate(texts):
        parts = by_doc[i or None]
        assert sum((parts[k] for k in sorted(parts)), []) == encoding.encode_ordinary(t or "") + [end]
    again = write_sequences(docs, str(tmp_path / "again"), RANKS, length=64, shard_bytes=2000)
    assert sorted(map(tuple, list_sequences(spark, again).collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert list_sequences(spark, write_sequences(docs.limit(0), str(tmp_path / "none"), RANKS)).collect() == []


# -- fingerprints -----------------------------------------------------------------------------


def test_winnowing_matches_its_definition(monkeypatch):
    rng = random.Random(7)
    for text in ["", "a", "ab" * 40, "x" * 300, "".join(rng.choice("abc ") for _ in range(500)), "é漢😀" * 30]:
        for gram, window in ((3, 4), (5, 8), (24, 64)):
            found, places = winnow(text, gram, window)
            if not text:
                assert len(found) == 0
                continue
            g = min(gram, len(text))
            # 40 bits decide, 32 are kept; a run's hash depends on its characters alone.
            each = {text[i : i + g]: int(winnow(text[i : i + g], g, 1)[0][0]) for i in range(len(text) - g + 1)}
            hashes = [each[text[i : i + g]] for i in range(len(text) - g + 1)]
            assert places.tolist() == chosen(text, hashes, window)
            assert found.tolist() == [hashes[p] for p in places]
            monkeypatch.setattr(fingerprints, "PIECE", 50)
            assert all(np.array_equal(a, b) for a, b in zip(winnow(text, gram, window), (found, places), strict=True))
            monkeypatch.undo()


def test_shared_passages_share_a_hash():
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    for _ in range(20):
        passage = word(fingerprints.GRAM + fingerprints.WINDOW - 1)
        one, other = (winnow(word(rng.randrange(200)) + passage + word(rng.randrange(200)))[0] for _ in range(2))
        assert likeness(one, other) > 0


def test_edits_match_brute_force(spark):
    rng = random.Random(9)
    texts = [None, "", "a", "abc", "漢字é" * 9, *("".join(rng.choice("abcdef ") for _ in range(rng.randrange(900))) for _ in range(40))]
    docs = [(i * 7 - 20, t) for i, t in enumerate(texts)]
    table = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, part string").repartition(5)
    got = {r.id: r for r in compare_edits(table).collect()}
    assert len(got) == len(docs)
    for (i, t), (_, following) in zip(docs, docs[1:] + docs[:1], strict=True):
        t, following = t or "", following or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + following[:cut]
        r, own = got[i], winnow(t)[0]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == fingerprints.printed(own) and r.edited_fingerprint == fingerprints.printed(winnow(edited)[0])
        assert r.near_edited == likeness(own, winnow(edited)[0]) and r.near_next == likeness(own, winnow(following)[0])
    same = spark.createDataFrame([(None, "x y"), (None, "x y"), (3, "z"), (3, "z")], "doc_id long, text string")
    assert compare_edits(same).count() == 4 and compare_edits(same.limit(1)).count() == 1 and compare_edits(same.limit(0)).count() == 0
    row = fingerprint(table).where("id = 64").first()
    assert row.hashes == winnow(texts[12])[0].tolist() and row.positions == winnow(texts[12])[1].tolist()


def test_rows_without_id_are_spread_and_followed_rightly(spark, tmp_path):
    """A third of the rows have no id, half of those are alike; a tenth share another id."""
    text = "concat('text ', if(id % 6 = 0, 0, id), repeat('y', int(id % 5)))"
    ids = "if(id % 3 = 0, null, if(id % 10 = 1, 5000, id))"
    spark.range(6000).selectExpr(f"{ids} doc_id", f"if(id % 6 = 0, 'alike', {text}) text").write.parquet(str(tmp_path / "docs"))
    table = spark.read.parquet(str(tmp_path / "docs"))
    n = fingerprints.partitions(spark)
    placed = fingerprints.in_order(table, "doc_id", "text").withColumn("part", F.spark_partition_id())
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"), F.count_if("copy").alias("copies")).collect()
    assert len(sizes) == n and max(r.n for r in sizes) < 2 * 6000 / n and all(r.copies == 1 for r in sizes)
    low = -(1 << 63)
    rows = table.select("doc_id", "text", F.xxhash64("text").alias("tie")).collect()
    rows = sorted((low if r.doc_id is None else r.doc_id, r.tie, r.text) for r in rows)
    want = []
    for (_, _, t), (_, _, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        cut = len(t) // 4
        want.append(hashlib.sha256((t[: len(t) - cut] + following[:cut]).encode()).hexdigest())
    assert sorted(r.edited_sha256 for r in compare_edits(table).select("edited_sha256").collect()) == sorted(want)


# -- mixing -----------------------------------------------------------------------------------


def test_targets_are_reshared_until_none_is_above():
    sizes = {"a": 100, "b": 10, "c": 10, "d": 1000, None: 0}
    weights = mixing.default_weights(sizes)
    assert weights == {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}
    want = mixing.targets(sizes, weights)
    assert want == {"a": 300.0, "b": 30.0, "c": 30.0, "d": 760.0, None: 0.0}


def test_mix_gives_targets_and_caps(spark):
    rng = random.Random(10)
    rows = [(i, " ".join(["w"] * rng.randrange(300)), rng.choice(["b", "b", "b", "a", "é", "z", None])) for i in range(600)]
    rows += [(None, None, "a"), (7000, "", "b"), *rows[:3]]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, row int").repartition(4)
    found = mixing.taken(*mixing.schedule(docs, block=64)).collect()
    assert len(found) == len(rows)
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        assert sum(r.size for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5
        assert all(0 <= r.taken <= 3 * r.size for r in own)
    assert sorted((r.id or -1, r.taken) for r in found) == sorted((r.id or -1, r.taken) for r in mixing.taken(*mixing.schedule(docs.repartition(7), block=64)).collect())
    mixed = mixing.mix(docs, block=64)
    assert mixed.columns == docs.columns
    assert abs(mixed.select(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0] - sum(r.taken for r in found)) < 300 * 10
    assert mixing.taken(*mixing.schedule(docs.limit(0))).collect() == [] and mixing.mix(docs.where("text = ''")).collect() == []


def test_any_stretch_of_the_mix_has_the_shares(spark):
    docs = spark.createDataFrame([(i, "w " * 100, "abc"[i % 3]) for i in range(300)], "doc_id long, text string, source string")
    documents, pieces = mixing.schedule(docs, block=50)
    rows = pieces.join(documents.select("row", "source"), "row").where("slot between 100 and 219").groupBy("source").agg(F.sum("words").alias("n")).collect()
    share = {r.source: r.n / sum(x.n for x in rows) for r in rows}
    assert all(abs(share[s] - w) < 0.02 for s, w in (("a", 1 / 6), ("b", 2 / 6), ("c", 3 / 6)))


# -- quality ----------------------------------------------------------------------------------


def test_quality_on_held_out_documents(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    learnt = labels.where("pmod(doc_id, 3) > 0")
    model = quality.train(docs, learnt)
    assert (np.diff(model.thresholds) > 0).all()
    held_out = labels.where("pmod(doc_id, 3) = 0")
    rows = quality.grade(docs, model, keep=["doc_id"]).join(held_out, F.col("k0") == F.col("doc_id")).collect()
    right = [(r.p_good >= quality.TAIL) == (r.quality > r.toxic) for r in rows]
    clean = [r.p_good >= quality.TAIL for r in rows if r.quality > r.toxic]
    toxic = [r.p_good >= quality.TAIL for r in rows if r.toxic]
    assert len(rows) > 900 and np.mean(right) > 0.97 and np.mean(clean) > 0.98 and np.mean(toxic) < 0.1
    assert all(abs(r.expected_grade - r.p_clean - r.p_good) < 1e-9 and r.p_good <= r.p_clean for r in rows)


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "good text", 9), (3, "good text", 9), (None, "x", 9)], "doc_id long, text string, grade int")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 1), (3, 0, 0), (3, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for rated in (labels, labels.limit(0), labels.where("quality is null")):
        model = quality.train(docs, rated)
        graded = quality.grade(docs, model).collect()
        assert len(graded) == 5 and all(0 <= r.p_good <= r.p_clean <= 1 for r in graded)
        assert quality.select_good(docs, model).columns == docs.columns
    assert quality.train(docs, labels.limit(0)) is None
    assert quality.select_good(docs, None).count() == 5 and quality.select_good(docs.limit(0), model).count() == 0


# -- chats ------------------------------------------------------------------------------------


def turns_of(convs):
    return [(c, i, *t) for c, turns in convs.items() for i, t in enumerate(turns)]


@pytest.mark.parametrize("chunk", [1024, 2])
def test_snapshots_collapse(spark, chunk):
    a = [("user", "hi"), ("assistant", "ho"), ("user", None), ("assistant", "<|im_end|>")]
    convs = {5: a[:1], 3: a[:2], 9: a, 4: a, 7: [("user", "hi"), ("assistant", "other")], 8: [("user", "ho")], 6: [("user", "hi"), ("assistant", "ho"), ("user", ""), ("assistant", "x")]}
    rows = turns_of(convs) + [(None, 0, "user", "hi"), (11, None, None, "late"), (11, 3, "user", "first"), (12, 0, "user", "twice"), (12, 0, "user", "twice")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int").repartition(3)
    got = format_chats(table, chunk=chunk).collect()
    full = {}
    for r in sorted(got, key=lambda r: (r.conv_id, r.part)):
        full[r.conv_id] = full.get(r.conv_id, "") + r.text
    assert set(full) == {4, 6, 7, 8, 11, 12}
    assert {r.conv_id: (r.n_turns, r.copies) for r in got}[4] == (4, 2)
    assert full[4] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nho<|im_end|>\n<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n<| im_end|><|im_end|>\n"
    assert full[11] == "<|im_start|>user\nfirst<|im_end|>\n<|im_start|>\nlate<|im_end|>\n"
    assert full[12].count("twice") == 2
    assert max(r.part for r in got) == (0 if chunk == 1024 else 1)
    assert format_chats(table.limit(0)).collect() == []


def test_turns_without_conversation_are_spread(spark):
    """A third of the turns have no conversation, and turn numbers that repeat."""
    table = spark.range(3000).selectExpr("if(id % 3 = 0, null, int(id / 9)) conv_id", "id % 4 turn", "if(id % 5 = 0, null, 'user') role", "concat('t', id % 700) text")
    want = prefix_hashes(table, chunk=64)
    got = prefix_hashes(table, chunk=64, hot_rows=100)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    chats = format_chats(table, chunk=64, hot_rows=100).where("conv_id is null").select("part", "n_turns", F.regexp_count("text", F.lit("<.im_start")).alias("n")).collect()
    assert sorted((r.part, r.n) for r in chats) == [(i, min(64, 1000 - 64 * i)) for i in range(16)]
    assert {r.n_turns for r in chats} == {1000}


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_chats_run_without_python(spark, hot_rows):
    table = spark.createDataFrame([(1, i, "user", "x") for i in range(9)], "conv_id long, turn long, role string, text string")
    plan = format_chats(table, hot_rows=hot_rows)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# -- pages ------------------------------------------------------------------------------------


FULL = """<html><head><title>T</title><body><header><h1>Site</h1><nav>m</nav></header><div id="cookie-notice">We use cookies</div>
<div class="layout with-sidebar"><main><article class="post"><header><h1>My   title</h1></header><p>One <b>two</b>&nbsp;three &amp; <p>Four
<div class="ad-box">Buy</div><ul><li>a<li>b</ul><form>x<input></form><table><tr><td>1<td>2<tr><td>3</table><aside>side</aside><footer>tags</footer>
</article><section id="comments"><article class="comment"><p>nice</p></article></section></main><div class="sidebar">sb</div></div><footer>f</footer>"""


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (FULL, "My title One two three & Four a b 1 2 3"),
        ("", ""),
        ("plain &lt;b&gt; text", "plain <b> text"),
        ("<div><a href=x>Home</a></div><div>real <a>link</a> in a text</div>", "real link in a text"),
        ("<p>a<![if x]>b</p><![endif]--><!-- c --> d <script>x</script>", "ab d"),
        ("<article><p><b>bold<br><p>next</p></article><p>after", "bold next"),
        ("<article></article><p>outside</p>", ""),
        ("<ul><li>x<ul><li>y</ul><li>z</ul><dl><dt>t<dd>d</dl>", "x y z t d"),
        ("<div hidden>no</div><div style='display: none'>no</div><p>yes", "yes"),
        ("<head><title>x</title><p>no head end", "no head end"),
        ("</p></div></article>stray", "stray"),
    ],
)
def test_main_text(html, text):
    assert Page(html).text(set()) == text


def test_style_tree_removes_what_a_host_repeats(spark):
    rows = []
    for i in range(8):
        body = f"<p>text number {i} of its own</p><div class='k9'>the same lines on every page</div><h2>Summary</h2><p>and more {i * i}</p>"
        rows.append((i, f"http://Host.example/{i}", f"<article>{body}</article>"))
        rows.append((100 + i, f"http://other.example/{i}", "<article><p>a mirrored page</p></article>"))
        rows.append((200 + i, f"http://bare.example/{i}", f"<div>masthead line</div><div>bare text {i}</div>"))
    rows += [(500, "http://lone.example/", rows[0][2]), (501, None, rows[0][2]), (502, "", None), rows[0]]
    table = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, key string").repartition(4)
    got = extract(table).collect()
    assert len(got) == len(rows)
    text = {r.id: r.text for r in got}
    assert all(text[i] == f"text number {i} of its own Summary and more {i * i}" for i in range(8))
    assert all(text[100 + i] == "a mirrored page" and text[200 + i] == f"bare text {i}" for i in range(8))
    assert text[500] == text[501] == "text number 0 of its own the same lines on every page Summary and more 0"
    assert text[502] == ""
    assert extract(table.limit(0)).collect() == []
