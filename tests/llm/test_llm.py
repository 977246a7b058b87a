"""Operators against brute-force versions, on given tables and on tables of edge cases."""

import hashlib
import math
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from compare import connect, difference
from conftest import DATA
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tipoff.llm import decontamination, embeddings, html, jaccard, language_model, lines, packing, passages, toxicity, warc
from tipoff.llm import text as tx
from tipoff.llm.components import components, forest
from tipoff.llm.queries import ORACLE, QUERIES, table

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("w" + str(x) for x in rng.integers(0, 5000, n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, long texts, ties, repeated rows, near copies, and clashing columns."""
    base = sentence(1, 120)
    near = base.replace(base.split()[60], "other", 1)
    poem = "\n".join(sentence(100 + i, 6) for i in range(40))
    texts = [
        (1, base), (2, base), (3, near), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "ONE"), (9, "one two three"),
        (10, poem), (11, sentence(7, 9) + "\n" + poem), (12, sentence(3, 60) + " " + base), (13, "É à ß 中文 😀 \x1c x"),
        (14, sentence(5, 20_000)), (14, sentence(6, 30)), (15, base), (15, base), (16, "the the the " * 60),
    ]
    rows = [(i, t, None, None, None) for i, t in texts]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("row", "node", "text_2", "owner", "label", "features", "score", "bucket", "start"):
        df = df.withColumn(name, F.lit(7))
    return df


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def given(spark):
    return table(spark, DATA, "documents")


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def same(left, right):
    assert Counter(left) == Counter(right)


# --- connected components ---------------------------------------------------------------


def test_components(spark):
    rng = np.random.default_rng(0)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1100)]
    got = dict(components(spark.createDataFrame(pairs, "x long, y long").repartition(5)).collect())
    want = dict(forest([p for p in pairs if p[0] != p[1]]))
    assert got == want | {top: top for top in want.values()}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


# --- 1: embeddings ----------------------------------------------------------------------


def brute_vectors(rows, limit=0.9):
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    counts, links = Counter(), []
    for a in range(len(good)):
        for b in range(a):
            (i, x), (j, y) = good[a], good[b]
            if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= limit:
                counts[i] += 1
                counts[j] += 1
                links.append((i, j))
    tree = dict(forest(links))
    return {(i, counts[i], tree.get(i, i), tree.get(i, i) == i) for i, _ in rows}


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    monkeypatch.setattr(embeddings, "FAN_OUT", 2)
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        centre = np.random.default_rng(i % 40).normal(size=12)
        rows.append((i, [float(x) for x in centre + rng.normal(size=12) * rng.choice([0.1, 0.5])]))
    rows += [(1000 + i, rows[3][1]) for i in range(20)]
    rows += [(2000, None), (2001, [0.0] * 12), (2002, [math.nan] + [1.0] * 11), (2003, [None] + [1.0] * 11), (2004, [])]
    rows += [(2005, [1.0, 2.0]), (2006, [1.0, 2.0]), (2007, [-0.0, 3.0]), (2008, [0.0, 3.0]), (2009, [math.inf, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rep", F.lit(1))
    same([tuple(r) for r in embeddings.near_duplicates(df).collect()], brute_vectors(rows))
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


# --- 2: packing -------------------------------------------------------------------------


def check_packed(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("which", ["odd", "given"])
def test_packing(which, request):
    docs = request.getfixturevalue(which)
    got = packing.pack(packing.pieces(docs, public_tokenizers.path(packing.VOCABULARY))).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    want, total = [], 0
    for i, text in rows_of(docs):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        want += [(i, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
    same([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], want)
    assert check_packed(got, 2048) <= math.ceil(total / 2048) + 2


def test_packing_rounds(spark, nothing):
    rng = np.random.default_rng(1)
    lengths = [int(x) for x in rng.integers(1, 2047, 3000)]
    rows = [(i, i, 0, 0, n, 1) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "doc_id long, row long, piece int, start long, length long, ids_crc32 long")
    one = check_packed(packing.pack(df).collect(), 2048)
    many = packing.pack(df, part_pieces=1000).collect()
    assert len(many) == 3000 and check_packed(many, 2048) <= 1.02 * one
    assert packing.pack(packing.pieces(nothing, public_tokenizers.path(packing.VOCABULARY))).count() == 0


def test_lower_bound_is_one():
    rng = np.random.default_rng(3)
    for _ in range(50):
        lengths = rng.integers(1, 101, rng.integers(1, 60))
        assert packing.lower_bound(lengths, 100) <= packing.best_fit(lengths, 100)[2]
    assert packing.lower_bound(np.array([51] * 7), 100) == 7
    assert packing.lower_bound(np.array([34] * 6), 100) == 3


# --- 3: language model ------------------------------------------------------------------


@pytest.mark.parametrize("which", ["odd", "given"])
def test_base_score(which, request):
    docs = request.getfixturevalue(which)
    words = [(i, [*(t or "").translate(LOWER).encode().split(), b"\n"]) for i, t in rows_of(docs)]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, ws in words if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = [
        (i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 4))
        for i, ws in words
    ]
    got = language_model.score(docs, public_tokenizers.path(packing.VOCABULARY)).collect()
    same([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got], want)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_scores_are_probabilities_of_each_id_once():
    """The batched windows give what a loop over single positions gives, and sum to one."""
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 300, n) for n in (0, 1, 31, 32, 33, 60, 200)]
    counts = np.bincount(np.concatenate(texts), minlength=language_model.IDS + 1)
    classes, rank = language_model.classes_of(counts), language_model.ranks_of(counts)
    after = np.zeros((language_model.RANKS + 1, language_model.RANKS))
    for t in texts:
        r = rank[np.append(t, language_model.END)]
        np.add.at(after, (np.append(language_model.RANKS, r[:-1]), r), 1)
    counts[language_model.END] = len(texts)
    parts = language_model.count_parts(classes, rank, counts.astype(float), after)
    model = language_model.train(classes, parts, *language_model._training_windows(texts, classes, rank))

    def loop(text):
        cls = np.append(classes.begin, classes.of[text])
        ids = np.append(text, language_model.END)
        total = 0.0
        for t in range(len(ids)):
            begin = 0 if t < 32 else 24 * (-(-(t - 31) // 24))
            x = cls[begin : t + 1]
            s = np.array([model.query[x[-1]] @ model.key[k] + model.bias[len(x) - 1 - j] for j, k in enumerate(x)])
            a = np.exp(s - s.max())
            o = (a / a.sum()) @ model.value[x]
            before = language_model.RANKS if t == 0 else rank[ids[t - 1]]
            z = o @ model.out + model.prior[before]
            z = z - np.log(np.exp(z).sum())
            p = np.exp(z[classes.of] + model.within[before][rank] + model.rare)
            assert p.sum() == pytest.approx(1, abs=1e-3)
            total += math.log10(p[ids[t]])
        return total

    np.testing.assert_allclose(language_model.score_texts(model, texts), [loop(t) for t in texts], rtol=1e-4)


def test_scoring_reads_attention_from_tables(monkeypatch):
    """Scores from tables by class equal those of the attention itself, which is used only for heads out of range."""
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 300, n) for n in (0, 1, 31, 32, 33, 60, 200)]
    counts = np.bincount(np.concatenate(texts), minlength=language_model.IDS + 1).astype(float)
    classes, rank = language_model.classes_of(counts), language_model.ranks_of(counts)
    after = np.zeros((language_model.RANKS + 1, language_model.RANKS))
    parts = language_model.count_parts(classes, rank, counts, after)
    model = language_model.train(classes, parts, *language_model._training_windows(texts, classes, rank))
    attend, calls = language_model.attend, []
    monkeypatch.setattr(language_model, "attend", lambda *x: calls.append(1) or attend(*x))
    tabled = language_model.score_texts(model, texts)
    assert not calls
    monkeypatch.setattr(language_model, "attention_of", lambda model: None)
    np.testing.assert_allclose(language_model.score_texts(model, texts), tabled, rtol=1e-6)
    assert calls
    monkeypatch.undo()
    assert language_model.attention_of(model._replace(query=model.query * 1e4)) is None


def test_score_of_nothing(nothing):
    assert language_model.score(nothing, public_tokenizers.path(packing.VOCABULARY)).count() == 0


# --- 4: lines ---------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["odd", "given"])
def test_lines(which, request):
    docs = request.getfixturevalue(which)
    rows = rows_of(docs)
    own = {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        for c in lines.chunks(text):
            if len(c) > 1:
                own.setdefault(b"\n".join(c), i)
    want = []
    for i, text in rows:
        seen, left, n = set(), [], 0
        for c in lines.chunks(text):
            key = b"\n".join(c)
            gone = len(c) > 1 and (own[key] < i or key in seen)
            seen.add(key)
            n += len(c) * gone
            left += [] if gone else c
        want.append((i, n, b"\n".join(left).decode()))
    same([(r.doc_id, r.n_removed, r.kept) for r in lines.remove_repeats(docs).collect()], want)


def test_chunks_realign():
    text = "\n".join(sentence(i, 5) for i in range(200))
    a, b = lines.chunks(text), lines.chunks("a new first line\n" + text)
    assert b"\n".join(x for c in a for x in c).decode() == text
    assert len({tuple(c) for c in a} & {tuple(c) for c in b}) >= len(a) - 2


# --- 5: archives ------------------------------------------------------------------------


def test_archive_matches_sql(spark):
    assert difference(QUERIES["op5_warc"](spark, DATA), connect(DATA), ORACLE["op5_warc"]) is None


def test_archive_edges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SEGMENT_BYTES", 700)
    long = "<p>" + "é\r\n0\r\n\r\nWARC/1.1" * 1000
    pages = [(1, "u", None), (2, None, ""), (3, "a b\nc", long), (4, "u", long), (None, "u", long), (5, "u", "x" * 99), (6, "u", "x" * 99)]
    pages += [(7, "v", "y" * 100), (7, "v", "y" * 100), (8, "v", "y" * 100)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("z"))
    got = {r.page_id: r for r in warc.round_trip(df, str(tmp_path / "w")).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, 8, None}
    for i, _, text in pages:
        data = (text or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
    assert {i: r.refers_to for i, r in got.items() if r.record_type == "revisit"} == {4: 3, 8: 7}
    read = {r.page_id: r for r in warc.read_pages(warc.write_archives(df, str(tmp_path / "v"))).collect()}
    assert bytes(read[3].payload).decode() == long and read[3].url == "a%20b%20c"
    assert warc.round_trip(df.limit(0), str(tmp_path / "e")).count() == 0


def test_damaged_archives_are_noticed(spark, tmp_path):
    with pytest.raises(ValueError):
        warc.unframed(b"5\r\nabc\r\n0\r\n\r\n")
    assert warc.unframed(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    rows = [("o", 1, None, b"ab"), ("o", 3, 4, b"cd")]
    df = spark.createDataFrame(rows, "origin string, segment int, total long, block binary")
    df = df.select("*", F.lit("response").alias("record_type"), F.lit(1).cast("long").alias("page_id"), F.lit("u").alias("url"), F.lit("d").alias("digest"))
    with pytest.raises(Exception, match="segments are missing"):
        warc.reassemble(df).collect()


# --- 6: decontamination -----------------------------------------------------------------


def brute_contamination(docs, items):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        words = pattern.findall((text or "").translate(LOWER))
        size = min(13, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[k : k + size])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for i, text in docs:
        words = pattern.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                if (w := tuple(words[k : k + size])) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[w]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return out


@pytest.mark.parametrize("which", ["odd", "given"])
def test_contamination(spark, which, request, monkeypatch):
    docs = request.getfixturevalue(which)
    monkeypatch.setattr(decontamination, "SHARD_WORDS", 3000)
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 2000)  # several blocks
    words = sentence(1, 120).split()
    extra = [(90, " ".join(words[10:40])), (91, "ONE"), (92, None), (93, "  "), (9, "one, two"), (10, "One two"), (94, " ".join(words[20:33]))]
    items = [(r.item_id, r.text) for r in table(spark, DATA, "benchmark").collect()] + extra
    df = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    same([tuple(r) for r in decontamination.contamination(docs, df).collect()], brute_contamination(rows_of(docs), items))


def test_proximity_and_empty(spark, nothing):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a x x x x x x b"), (3, "b"), (4, "a")], "doc_id long, text string")
    index = decontamination.build_index(docs)
    blocks = [decontamination.item_windows([("i", "a b")])]
    assert [r.doc for r in decontamination.search(index, blocks).collect()] == [0]
    near = lambda slop: decontamination.search(index, blocks, slop).count()
    assert (near(1), near(6), near(7)) == (1, 1, 2)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(nothing, empty).count() == 0
    assert decontamination.contamination(docs, empty).where("n_hit > 0 or contaminated").count() == 0


# --- 7: pages ---------------------------------------------------------------------------


def test_given_pages_give_their_article(spark):
    from html import unescape

    for r in html.main_text(table(spark, DATA, "pages"), keep=("page_id", "html")).collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inner)
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", " " if "br" in b else "", b)).split()) for b in blocks]
        assert r.text == "\n".join(b for b in blocks if b), r.page_id


def test_page_parts():
    long = "This is a sentence of the story that says something at length, and goes on. " * 3
    page = f"""<html><head><title>t</title><style>p{{}}</style></head><body><header><a href=/>Site</a></header>
    <nav><ul><li><a href=a>Menu</a><li><a href=b>More</a></ul></nav><div class="cookie-notice">We use cookies, please accept all of them now.</div>
    <article><h1>Head &amp; line</h1><p>{long}<p>Short.<br>Next<div class="ad">Buy this thing now, it is cheap and good.</div>
    <aside><p>{long}</aside><form><label>Name</label><input></form><ul><li>one<li>two</ul><script>var a = "<p>no</p>";</script></article>
    <section id="comments"><p>{long}</p></section><footer>&copy; us</footer>"""
    clean = " ".join(long.split())
    assert html.extract(page) == f"Head & line\n{clean}\nShort. Next\none\ntwo"
    soup = f"<body><div><a href=1>Home</a> <a href=2>News</a></div><div><p>{long}</p><p>{long}</p><p>End.</p></div><div><a href=3>x</a></div>"
    assert html.extract(soup) == f"{clean}\n{clean}\nEnd."


def test_page_edges(spark):
    assert [html.extract(x) for x in (None, "", "<", "<p>", "plain", "&lt;b&gt;", "<!-- x", "</p></div>a")] == ["", "", "<", "", "plain", "<b>", "", "a"]
    df = spark.createDataFrame([(1, None, None), (None, "u", "<p>a"), (1, None, None)], "page_id long, url string, html string")
    same([tuple(r) for r in html.main_text(df.withColumn("text", F.lit(3))).collect()], [(1, None, ""), (1, None, ""), (None, "u", "a")])


# --- 8: passages ------------------------------------------------------------------------


@pytest.mark.parametrize("hot", [None, 2])
@pytest.mark.parametrize("which", ["odd", "given"])
def test_passages(which, hot, request):
    docs = request.getfixturevalue(which)
    rows = [(i, (t or "").encode().split()) for i, t in rows_of(docs)]
    own = {}
    for i, w in sorted(rows, key=lambda r: r[0]):
        for k in range(len(w) - 49):
            own.setdefault(tuple(w[k : k + 50]), i)
    want = []
    for i, w in rows:
        gone = {j for k in range(len(w) - 49) if own[tuple(w[k : k + 50])] < i for j in range(k, k + 50)}
        want.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    got = passages.remove_repeats(docs, hot_strings=hot).collect()
    same([(r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in got], want)


def test_passages_survive_a_lying_hash(spark, monkeypatch):
    from tipoff.llm import text

    texts = [b"a b c d", b"c d a b", b"a b c d"]
    data = b"\n".join(texts)
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    offsets[-1] -= 1
    part = text.Slice(0, offsets, np.frombuffer(data, np.uint8))
    want = passages._first_equal(data, part, 2)[1].tolist()
    monkeypatch.setattr(text, "window_hashes", lambda words, starts, lengths: np.zeros(len(starts), np.uint64))
    assert passages._first_equal(data, part, 2)[1].tolist() == want == [0, 1, 2, 2, 4, 0, 0, 1, 2]


# --- 9: Jaccard join --------------------------------------------------------------------


def brute_groups(rows):
    sets = []
    for i, text in rows:
        w = (text or "").translate(LOWER).encode().split()
        sets.append((i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())))
    links = []
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            o = len(x & y)
            if o and 100 * o >= 80 * (len(x) + len(y) - o):
                links.append((i, j))
    tree = dict(forest([p for p in links if p[0] != p[1]]))
    return [(i, len(s), tree.get(i, i)) for i, s in sets]


@pytest.fixture(scope="module")
def copies(spark):
    rng = np.random.default_rng(5)
    rows = []
    for group in range(6):
        words = sentence(50 + group, 80).split()
        for _ in range(30):
            own = list(words)
            for k in rng.integers(0, 80, rng.integers(0, 4)):
                own[k] = "x" + str(rng.integers(0, 9))
            rows.append((len(rows), " ".join(own)))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("tile", [None, 500])
@pytest.mark.parametrize("which", ["odd", "given", "copies"])
def test_jaccard(which, tile, request):
    docs = request.getfixturevalue(which)
    same([tuple(r) for r in jaccard.near_duplicates(docs, tile_shingles=tile).collect()], brute_groups(rows_of(docs)))


def test_jaccard_of_nothing(nothing):
    assert jaccard.near_duplicates(nothing).count() == 0


# --- 10: toxicity -----------------------------------------------------------------------


def test_toxicity(spark, given):
    got = toxicity.op10_toxicity(spark, DATA).collect()
    ids = [r.doc_id for r in got]
    assert sorted(ids) == sorted(i for i, _ in rows_of(given))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    labels = {r.doc_id: r.toxic for r in table(spark, DATA, "labels").collect()}
    known = [(r.score, labels[r.doc_id]) for r in got if r.doc_id in labels]
    bad, good = [s for s, y in known if y], [s for s, y in known if not y]
    assert np.mean([x > y for x in bad for y in good]) > 0.9


def test_toxicity_edges(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (2, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 for r in toxicity.score(odd, labels.limit(0)).collect())
    assert toxicity.score(nothing, labels).count() == 0


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    rows = [(i, int(i % 2), 1) for i in range(100)]
    known = toxicity.sample(spark.createDataFrame(rows, "doc_id long, quality int, toxic int")).collect()
    assert {r.doc_id for r in known} == {i for i in range(100) if zlib.crc32(str(i).encode()) % 5}


# --- pipeline ---------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path, given):
    docs, ids = given, {i for i, _ in rows_of(given)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, DATA).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == given.columns
        after = {r.doc_id: r for r in docs.collect()}
        if name == "toxicity":
            scored = toxicity.score(given, table(spark, DATA, "labels")).where("predicted = 0")
            want = {r.doc_id for r in scored.collect()}
        elif name == "line_dedup":
            cut = lines.remove_repeats(spark.read.parquet(str(tmp_path / "toxicity"))).collect()
            want = {r.doc_id for r in cut if r.kept or not r.n_removed}
            assert all(after[r.doc_id].text == r.kept for r in cut if r.doc_id in want)
        elif name == "ngram_jaccard":
            want = {i for i, _, c in brute_groups([(r.doc_id, r.text) for r in before.values()]) if i == c}
        else:
            items = [(r.item_id, r.text) for r in table(spark, DATA, "benchmark").collect()]
            want = {r[0] for r in brute_contamination([(r.doc_id, r.text) for r in before.values()], items) if not r[5]}
        assert set(after) == want <= ids
        assert all(r.n_chars == len(r.text) and r.lang == before[i].lang for i, r in after.items())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    check_packed(packed, 2048)


def test_pipeline_edges(spark, odd, nothing):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs.select(*corpus_pipeline.COLUMNS), DATA)
            assert out.count() <= docs.count() or name == "packing"


def test_registered(spark):
    import __spark_entry__ as contract

    names = contract.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names


def test_classes_are_counted_over_the_whole_training_part(spark, monkeypatch):
    """Counts of ids and pairs against a plain loop, with a sample far smaller than the corpus."""
    monkeypatch.setattr(language_model, "SAMPLE_ROWS", 1)
    vocabulary = public_tokenizers.path(packing.VOCABULARY)
    docs = spark.createDataFrame([(i, f"alpha beta {'gamma ' * (i % 4)}{i}") for i in range(40)], "doc_id long, text string")
    read = language_model._read(docs, vocabulary, 1).cache()
    kept = [np.frombuffer(r.ids, "<u2").astype(int) for r in read.where("ids is not null and not held_out").collect()]
    assert 0 < len(kept) < 40
    counts = np.bincount(np.concatenate([np.append(t, language_model.END) for t in kept]), minlength=language_model.IDS + 1)
    np.testing.assert_array_equal(language_model._id_counts(read), counts)
    rank = language_model.ranks_of(counts)
    after = np.zeros((language_model.RANKS + 1, language_model.RANKS))
    for t in kept:
        r = rank[np.append(t, language_model.END)]
        np.add.at(after, (np.append(language_model.RANKS, r[:-1]), r), 1)
    np.testing.assert_array_equal(language_model._count_pairs(read, rank), after)


def test_letters_outside_ascii_go_to_the_model_at_once(monkeypatch):
    """Only what follows a word, and words of other signs, take the tokenizer's whole way."""
    path = public_tokenizers.path(packing.VOCABULARY)
    words, whole = packing.WordIds(path), []
    add = words._add
    monkeypatch.setattr(words, "_add", lambda new, *more: (whole.extend(new := list(new)), add(new, *more)))
    texts = ["Größe, naïve ÉTÉ!! plain Plain", "ßß 中文 été\tÿ x1 K straße."]
    tokenizer = Tokenizer.from_file(path)
    for _ in range(2):
        want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert list(words.of(texts)) == want
    assert set(whole) - {""} <= {",", "!!", ".", "中文", "ÿ", "x1", "K"}


def test_shingles_are_shipped_without_sizes_and_in_short_runs(spark):
    """15 bytes for a shingle alone in its bucket, 6 for one more of the same document."""
    docs = spark.createDataFrame([(i, sentence(900 + i, 700 + 100 * i)) for i in range(5)], DOCS.split(", lang")[0])
    total = sum(n - jaccard.SHINGLE + 1 for n in range(700, 1200, 100))
    for buckets in (1, 40):
        rows = jaccard._ship(docs, buckets, jaccard.SHINGLE).collect()
        runs = sum(len(r.counts) for r in rows)
        assert sum(sum(r.counts) for r in rows) == total and all(len(r.nodes) == 8 * len(r.counts) for r in rows)
        assert sum(len(v) for r in rows for v in r[1:]) == 9 * runs + 6 * total
    nodes = np.repeat([5, 7, 9], [600, 255, 1])
    head, counts = jaccard._runs(nodes)
    assert list(counts) == [255, 255, 90, 255, 1]
    np.testing.assert_array_equal(jaccard._unpack_nodes(nodes[head].tobytes(), counts), nodes)


def test_pipeline_stages_take_small_batches_and_release_memory(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(tx, "release", lambda: calls.append(1))
    assert list(tx.releasing(lambda rows: (x + 1 for x in rows))(iter([1, 2]))) == [2, 3] and calls == [1]
    assert tx.releasing_group(lambda group: group)("g") == "g" and calls == [1, 1]
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5)], DOCS)
    dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, DATA)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == str(corpus_pipeline.BATCH_ROWS)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_pipeline_stages_read_texts_in_small_batches(spark, tmp_path):
    """Every stage sets the reader's batch for its scans; rows of several batches all arrive."""
    key = "spark.sql.parquet.columnarReaderBatchSize"
    rows = [(i, f"line {i}\nsecond {i}", "en", "s", 12) for i in range(2 * corpus_pipeline.READER_ROWS + 1)]
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(str(tmp_path / "docs"))
    for name, stage in corpus_pipeline.STAGES:
        spark.conf.unset(key)
        docs = spark.read.parquet(str(tmp_path / "docs"))
        if name == "line_dedup":
            assert stage(spark, docs, DATA).count() == len(rows)
        else:
            stage(spark, docs.limit(3), DATA)
        assert int(spark.conf.get(key)) == corpus_pipeline.READER_ROWS <= 512, name
    spark.conf.unset(key)


def test_head_is_trained_on_every_window_of_the_training_part(spark, monkeypatch):
    """Samples of a few windows hold all windows of all training texts, and all of them move the weights."""
    vocabulary = public_tokenizers.path(packing.VOCABULARY)
    docs = spark.createDataFrame(
        [(i if i % 5 else None, " ".join(f"w{i}x{j}" for j in range(i * 40))) for i in range(12)], "doc_id long, text string"
    )
    read = language_model._read(docs, vocabulary, 1).cache()
    texts = [np.frombuffer(r.ids, "<u2").astype(int) for r in read.where("ids is not null and not held_out").collect()]
    counts = language_model._id_counts(read)
    classes, rank = language_model.classes_of(counts), language_model.ranks_of(counts)
    parts = language_model.count_parts(classes, rank, counts, language_model._count_pairs(read, rank))

    def windows(samples):
        found = []
        for r in samples.collect():
            pieces = np.split(np.frombuffer(r.pieces, "<u2"), np.cumsum(np.frombuffer(r.lengths, "<u4"))[:-1])
            found.append(language_model.piece_windows(pieces, classes, rank))
        return found

    want = language_model._training_windows(texts, classes, rank)
    one = language_model._samples(read)
    assert len(windows(one)) == 1
    monkeypatch.setattr(language_model, "SAMPLE_WINDOWS", 30)
    many = language_model._samples(read)
    assert len(windows(many)) > 5

    def listed(found):
        return sorted(map(repr, zip(*[np.concatenate(x).tolist() for x in zip(*found)])))

    assert listed(windows(many)) == listed(windows(one)) == listed([want])
    alone = language_model.train(classes, parts, *windows(one)[0])
    np.testing.assert_allclose(language_model._train_all(one, classes, parts).out, alone.out, rtol=1e-4, atol=1e-6)
    # One epoch over many samples: the mean of what each makes of the first weights, by windows.
    monkeypatch.setattr(language_model, "EPOCHS", 1)
    each = [(len(w[0]), language_model.train(classes, parts, *w)) for w in windows(many)]
    mean = sum(n * m.out.astype(float) for n, m in each) / sum(n for n, _ in each)
    np.testing.assert_allclose(language_model._train_all(many, classes, parts).out, mean, rtol=1e-4, atol=1e-6)
