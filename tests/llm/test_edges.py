"""Every operator on nulls, empty and long texts, ties, repeated rows, empty
tables and clashing extra columns, against brute force where there is one."""

import hashlib
import re
import struct
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

LONG = "the quick brown fox jumps over it " * 4000
BASE = " ".join(f"word{i} thing{i * 7 % 13}" for i in range(60))
TEXTS = [
    (1, "Hello World, this is a test of the MIT License.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, "   \n\t ", "de", "b"),
    (5, LONG, "en", "a"),
    (6, BASE, "en", "b"),
    (7, BASE, "en", "b"),
    (8, BASE.replace("word59", "changed"), "en", "c"),
    (9, "1234 5678 !!", "fr", "c"),
    (10, "Café İstanbul K naïve 中文文本 words", "fr", "c"),
    (10, "the same id with another text", "fr", "c"),
    (None, "a row without an id", "en", "a"),
    (12, "Licensed under CC BY-NC and the Apache License, Version 2.0; GNU General Public License", "en", "a"),
    (6, BASE, "en", "b"),
    (13, "a  b  double  spaces and tail ", "en", "a"),
    (14, "one <|endoftext|> two<|endoftext|>", "en", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    # Extra columns with the names that operators use.
    df = spark.createDataFrame(TEXTS, SCHEMA)
    return df.withColumns({"tokens": F.lit(1), "score": F.lit("x"), "n": F.lit(2), "key": F.lit("k"), "epoch": F.lit(9), "l0": F.lit("z"), "host": F.lit("h")}).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def raw(t):
    return (t or "").encode()


# --- packing


def encoder():
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids + [1]


def check_packing(rows, texts, length):
    """Every id in one piece; windows gapless, full but for the last."""
    encode = encoder()
    want = Counter((d, tuple(encode(t))) for d, t, *_ in texts)
    pieces = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        pieces.setdefault(r.sequence_id, []).append(r)
    for w, ps in pieces.items():
        at = 0
        for p in ps:
            assert p.offset == at
            at += p.length
        assert at == length or (at <= length and w == max(pieces))
    assert sum(r.length for r in rows) == sum(len(k[1]) * n for k, n in want.items())
    have = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    for (d, ids), n in want.items():
        # A document's pieces: those that lead from its start to its end.
        def covered(at):
            if at == len(ids):
                return True
            for (i, s, k, crc, total), left in have.items():
                if left and (i, s, total) == (d, at, len(ids)) and zlib.crc32(np.array(ids[s : s + k], "<u4").tobytes()) == crc:
                    have[i, s, k, crc, total] -= 1
                    if covered(at + k):
                        return True
                    have[i, s, k, crc, total] += 1
            return False

        assert all(covered(0) for _ in range(n))
    assert not any(have.values())


@pytest.mark.parametrize("options", [{}, {"length": 64}, {"length": 64, "targets": {"a": 1.0, "b": 3.0}}, {"length": 64, "most_queues": 2}, {"length": 50, "runs": 7, "targets": {"c": 1.0}}])
def test_packing(docs, options):
    from tallyspan.llm.packing import pack

    check_packing(pack(docs, **options).collect(), TEXTS, options.get("length", 2048))


@pytest.mark.parametrize("alphabet", [st.sampled_from(["a", "b", " ", "Z", "'s", "1", "é", "中", "\n", "\t", "\xa0", "\u2003", "\u3000", "\x1c", ".", "!-", "<|endoftext|>", "<|", "|>", "ª", "ʰ"]).map(str), st.characters(codec="utf-8")])
def test_fast_encoder_gives_the_tokenizers_ids(alphabet):
    from tallyspan.llm.packing import tokenizer

    fast, slow = tokenizer("byte_bpe_50k.json"), encoder()

    @settings(max_examples=400, deadline=None)
    @given(st.lists(alphabet, max_size=40).map("".join))
    def same(text):
        assert np.frombuffer(fast.encode(text), fast.kind).tolist() + [1] == slow(text)

    same()
    assert fast.fast is not None
    for text in ("hello <|endoftext|> world", "<|endoftext|>", "x" * 50_000, " " * 200_000, "\n" * 50_000 + "a"):
        assert np.frombuffer(fast.encode(text), fast.kind).tolist() + [1] == slow(text)
    assert np.frombuffer(fast.encode("hello <|endoftext|> world"), fast.kind).tolist() == [31373, 220, 50256, 995]


def test_packing_of_nothing(nothing):
    from tallyspan.llm.packing import pack

    assert pack(nothing).count() == 0


def test_credit_shares_every_window():
    from tallyspan.llm.packing import Credit

    totals = [1000, 10, 333, 57]
    credit = Credit(totals)
    h = np.arange(0, sum(totals) + 1)
    spent = np.stack([credit.spent(q, h)[0] for q in range(4)])
    assert (spent.sum(0) == h).all() and (np.diff(spent, axis=1) >= 0).all()
    assert (abs(spent - h[None, :] * np.array(totals)[:, None] / sum(totals)) < 3).all()
    goal = Credit([1000, 1000, 50], [1.0, 3.0, 1.0])
    spent = np.stack([goal.spent(q, np.array([100, 200, 2050]))[0] for q in range(3)])
    assert abs(spent[1][0] - 60) < 3 and list(spent[:, 2]) == [1000, 1000, 50]


def test_big_totals_stay_in_64_bits():
    """Beyond 10^14 quanta: the places of Python's integers, by the same rule."""
    from fractions import Fraction

    from tallyspan.llm.packing import Credit, floor_share, whole_rates

    big = Credit([700 * 10**11, 300 * 10**11])
    assert big.spent(0, np.array([10**14]))[0].dtype == np.int64 and big.spent(0, np.array([10**14]))[0][0] == 700 * 10**11
    assert big.window(1, np.array([300 * 10**11 - 1]), 2048)[0] == (10**14 - 1) // 2048
    assert Credit([700, 300]).window(0, np.array([0, 699]), 100).tolist() == [0, 9]
    rng = np.random.default_rng(1)
    whole = rng.integers(1, 1 << 50, 20_000)
    x, part = (rng.random((2, 20_000)) * whole).astype(np.int64)
    part[:100] = whole[:100]
    assert floor_share(x, part, whole).tolist() == [int(Fraction(int(a) * int(b), int(c))) for a, b, c in zip(x, part, whole)]
    goal = Credit([3 * 10**13, 10**13, 5], [1.0, 3.0, 0.0])
    h = np.array([4 * 10**12, 13333333333336, 10**13 + 10**13 // 3 + 30, 4 * 10**13 + 5])
    assert np.allclose(goal.spent(1, h)[0], [3 * 10**12, 10**13, 10**13, 10**13], atol=9) and goal.spent(2, h)[0].tolist() == [0, 0, 0, 5]
    assert whole_rates(np.array([4.0, 0.0, 3.0, 1.5])).tolist() == [8, 0, 6, 3] and whole_rates(np.zeros(2)).tolist() == [0, 0]
    with pytest.raises(ValueError):
        Credit([1 << 50])


@pytest.mark.parametrize("seed", range(4))
def test_pieces_of_targeted_queues_are_the_turns_of_their_quanta(seed):
    """Against all turns in a list: who is served at each quantum, from spent()
    alone; every token once, without gaps, rare and used-up queues as well."""
    from tallyspan.llm.packing import Layout

    rng = np.random.default_rng(seed)
    tokens = [int(x) for x in rng.choice([1, 3, 40, 700, 2000], 30)]
    weights = [float(x) for x in rng.choice([0.0, 0.01, 1.0, 2.5, 80.0], 30)]
    layout = Layout(tokens, weights, 64, 8)
    h = np.arange(layout.credit.total + 1)
    spent = np.stack([layout.credit.spent(q, h)[0] for q in range(30)])
    assert (spent.sum(0) == h).all() and (np.diff(spent, axis=1) >= 0).all()
    stream, seen = [], [0] * 30
    for a in range(0, layout.credit.total, 8):
        for q in np.argsort(layout.credit.place):
            n = min(int(spent[q, min(a + 8, layout.credit.total)]) * layout.quantum, tokens[q]) - seen[q]
            stream += [(int(q), seen[q] + i) for i in range(n)]
            seen[q] += n
    cuts = [(q, a, min(n, a + int(rng.integers(1, 300)))) for q, n in enumerate(tokens) for a in range(0, n, 300)]
    cuts = [(q, a, b - a) for q, a, b in cuts] + [(q, b, min(n, a + 300) - b) for (q, a, b), n in ((c, tokens[c[0]]) for c in cuts) if min(n, a + 300) > b]
    queue, first, n = (np.array(x, dtype=np.int64) for x in zip(*cuts))
    got = {}
    for row, low, high, seq, off in zip(*(x.tolist() for x in layout.pieces(queue, first, n))):
        for i in range(high - low):
            got[seq * 64 + off + i] = (cuts[row][0], cuts[row][1] + low + i)
    assert [got[i] for i in range(len(got))] == stream


def test_twenty_thousand_targeted_sources():
    """What a task holds is some numbers for each source, and shares are kept."""
    import pickle

    from tallyspan.llm.packing import Layout

    rng = np.random.default_rng(2)
    tokens = ((rng.pareto(1.1, 20_000) * 1e6).astype(np.int64) + 5_000_000).tolist()
    weights = [1.0 + i % 4 for i in range(20_000)]
    layout = Layout(tokens, weights, 2048, 8)
    assert len(pickle.dumps(layout)) < 2_000_000
    h = np.array([layout.credit.begins[1] // 2])
    for q in (0, 1, 777, 19_999):
        assert abs(layout.credit.spent(q, h)[0][0] - h[0] * weights[q] / sum(weights)) < 16


# --- URL lists


def test_url_lists(spark):
    from tallyspan.llm.url_lists import active_entries

    at = lambda d: __import__("datetime").datetime(2024, 1, 1 + d)
    entries = spark.createDataFrame(
        [("Bad.org", "add", "spam", at(1)), ("bad.org", "remove", "spam", at(5)), ("x.bad.org", "add", "ads", at(0)), ("x.bad.org", "add", "ads", at(0)), ("two.net", "add", "a", at(2)), ("two.net", "remove", "a", at(2)), (None, "add", "z", at(0))],
        "key string, action string, category string, at timestamp_ntz",
    )
    seen = [(1, "http://x.bad.org/p", at(3)), (2, "http://x.bad.org:80/p", at(5)), (3, "https://BAD.ORG./", at(1)), (4, "http://good.org", at(3)), (5, None, at(3)), (6, "no url", at(3)), (7, "http://bad.org", None), (8, "http://two.net", at(3)), (1, "http://x.bad.org/p", at(3)), (None, "http://u@bad.org/", at(4)), (9, "http://notbad.org", at(3))]
    caps = spark.createDataFrame(seen, "id long, url string, fetched timestamp_ntz").withColumn("blocked", F.lit("x")).withColumn("host", F.lit(1))
    out = active_entries(caps, entries, capture_id="id", url="url", fetched="fetched")
    got = Counter((r.id, r.n_active, r.categories, r.matched_key, r.blocked) for r in out.collect())
    none = lambda i: (i, 0, "", None, False)
    assert got == Counter({(1, 2, "ads,spam", "x.bad.org", True): 2, (2, 1, "ads", "x.bad.org", True): 1, (3, 1, "spam", "bad.org", True): 1, (None, 1, "spam", "bad.org", True): 1, none(4): 1, none(5): 1, none(6): 1, none(7): 1, none(8): 1, none(9): 1})
    assert active_entries(caps.limit(0), entries, capture_id="id", url="url", fetched="fetched").count() == 0
    assert active_entries(caps, entries.limit(0), capture_id="id", url="url", fetched="fetched").where("blocked").count() == 0


# --- licences


def test_url_lists_of_addresses(spark):
    """An address has no parent domains, and keys may end in dots."""
    from tallyspan.llm.url_lists import active_entries

    at = __import__("datetime").datetime(2024, 1, 2)
    entries = spark.createDataFrame([(k, "add", "c", at) for k in ("1.10", "168.1.10", "[2001:db8::1]", "10.0.0.1", "org.", "Dots.org..", "...")], "key string, action string, category string, at timestamp_ntz")
    urls = {"http://192.168.1.10/x": None, "http://[2001:DB8::1]:8080/": "[2001:db8::1]", "http://u:p@[2001:db8::2]/": None, "http://10.0.0.1:81": "10.0.0.1", "http://a.dots.org.": "dots.org", "http://1.2.3.4.dots.org": "dots.org", "http://[2001": None}
    caps = spark.createDataFrame([(i, u, at) for i, u in enumerate(urls)], "id long, url string, fetched timestamp_ntz")
    got = {r.url: r.matched_key for r in active_entries(caps, entries, capture_id="id", url="url", fetched="fetched").collect()}
    assert got == urls


def licence_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))


def test_licenses(docs, nothing):
    from tallyspan.llm.licenses import BASE as PHRASES
    from tallyspan.llm.licenses import scan

    def expected(t):
        w, places, labels = licence_words(t), [], set()
        for p, label in PHRASES:
            p = p.split()
            here = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            places += here
            labels |= {label} if here else set()
        return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))

    got = scan(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter((d, *expected(t)) for d, t, *_ in TEXTS)
    twelve = next(r for r in got if r.doc_id == 12)
    assert set(twelve.labels.split(",")) == {"apache", "cc-by", "cc-by-nc", "gpl"} and 0 < twelve.score <= 1
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)
    assert scan(nothing).count() == 0


def test_license_labels_and_scores_by_plain_search(spark):
    """Labels and score from a search of every template at every place."""
    from tallyspan.llm.licenses import BASE as PHRASES
    from tallyspan.llm.licenses import COMMON, FURTHER, TEXTS, scan

    whole = [t for t, *_ in FURTHER + TEXTS] + [p for p, _ in PHRASES]
    half = [" ".join(t.split()[: len(t.split()) * 2 // 3]) for t, *_ in TEXTS]
    torn = [" x ".join([t[:70], t[70:]]) for t, *_ in TEXTS]
    texts = [*whole, *half, *torn, *(k for _, k, _ in TEXTS), "public license", "gnu", "", None, "see the MIT License; " + TEXTS[3][0].upper(), "apache license version 2 0"] + ["plain words"] * 9
    templates = [(p, p, x, True) for p, x in PHRASES] + [(*t, False) for t in FURTHER + TEXTS]
    split = [licence_words(t) for t in texts]
    content = {w for t, *_ in templates for w in t.split()} - COMMON
    idf = {w: np.log((len(texts) + 1) / (sum(w in x for x in split) + 0.5)) for w in content}
    got = {r.doc_id: r for r in scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
    for i, w in enumerate(split):
        labels, best = set(), 0.0
        for text, key, label, base in templates:
            t, key = text.split(), key.split()
            start = next(j for j in range(len(t)) if t[j : j + len(key)] == key)
            mass = sum(idf[x] for x in t if x not in COMMON)
            for at in range(len(w)):
                if w[at : at + len(key)] == key:
                    held = sum(idf[x] for j, x in enumerate(t) if x not in COMMON and 0 <= at - start + j < len(w) and w[at - start + j] == x) / mass
                    if base or held >= 0.5:
                        labels.add(label)
                        best = max(best, held)
        assert got[i].labels == ",".join(sorted(labels)) and abs(got[i].score - min(1.0, best)) < 1e-9, texts[i]
    assert all("mit" in got[texts.index(t)].labels for t in (TEXTS[0][0], half[0]))


def test_license_overlaps_and_near_misses(spark):
    from tallyspan.llm.licenses import scan

    texts = [(1, "mit mit license license"), (2, "apache-license APACHE.LICENSE"), (3, "gnu general license public"), (4, "license apache"), (5, "xmit license")]
    got = {r.doc_id: (r.n_base, r.first_word, r.last_word) for r in scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {1: (1, 1, 1), 2: (2, 0, 2), 3: (0, None, None), 4: (0, None, None), 5: (0, None, None)}


# --- media


def test_media(docs, nothing):
    from tallyspan.llm.media import HEADER, payload_of, store_and_read, wav

    want = Counter()
    for d, t, *_ in TEXTS:
        p = raw(t) + bytes(-len(raw(t)) % 64 or (0 if t else 64))
        assert p == payload_of(raw(t)) and len(p) % 64 == 0 and p
        want[d, len(raw(t)), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(p) + HEADER, hashlib.sha256(wav(p)).hexdigest()] += 1
    got = store_and_read(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256) for r in got) == want
    assert len({r.feature for r in got if r.doc_id in (6, 7)}) == 1
    assert store_and_read(nothing).count() == 0


def test_media_come_from_their_stored_chunks(spark):
    """Files share chunks by the pool, a chunk may stand twice in one file, and
    whatever stored byte is altered, reading is an error."""
    from pyspark.errors import PythonException

    from tallyspan.llm import media

    rng = np.random.default_rng(8)
    block = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    common = block(9000)
    texts = [block(3000) + common + block(int(n)) for n in rng.integers(0, 3000, 12)] + [block(5000) for _ in range(6)] + [common + common, "", None] + ["the same"] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    held = media.store(docs)
    kinds = Counter((r.kind, r.kind == media.FILE and len(r.held) == len(r.chunks)) for r in held.rows.collect())
    assert kinds[media.FILE, True] >= 8 and kinds[media.FILE, False] >= 12 and kinds[media.POOL, False] >= 3 and held.hot_files and held.hot_chunks
    stored_bytes = sum(len(r.frame) for r in held.rows.collect())
    assert stored_bytes < 0.75 * sum(len(t or "") for t in texts)
    got = Counter((r.doc_id, r.payload_sha256) for r in media.read(held).collect())
    assert got == Counter((i, hashlib.sha256(media.payload_of(raw(t))).hexdigest()) for i, t in enumerate(texts))

    dictionary = held.dictionary

    @F.udf("binary")
    def altered(frame):
        box = media.Frames(dictionary, 3)
        data = box.unpack(bytes(frame))
        return box.pack(data[:-1] + bytes([data[-1] ^ 1]) if data else data)

    for kind in (media.FILE, media.POOL):
        some = held.rows.where(F.col("kind") == kind).orderBy("name").first().name
        bad = held.rows.withColumn("frame", F.when(F.col("name") == F.lit(some), altered("frame")).otherwise(F.col("frame")))
        with pytest.raises(PythonException, match="does not read back"):
            media._files(bad, held.shared, held.dictionary, held.hot_chunks).collect()
    gone = held.rows.where(F.col("kind") == media.FILE)
    with pytest.raises(PythonException, match="does not read back"):
        media._files(gone, held.shared, held.dictionary, held.hot_chunks).collect()


def test_chunks_follow_content():
    from tallyspan.llm.media import cuts

    data = np.random.default_rng(1).integers(0, 256, 60_000, dtype=np.uint8).tobytes()
    pieces = lambda d: (lambda e: [d[a:b] for a, b in zip([0, *e], e)])(cuts(d, 10, 256, 8192))
    a, b = pieces(data), pieces(b"inserted bytes" + data)
    assert b"".join(a) == data and all(256 <= len(p) <= 8192 for p in a[:-1])
    assert len(set(a) & set(b)) > 0.9 * len(a)
    assert cuts(b"", 10, 256, 8192) == [] and cuts(b"x", 10, 256, 8192) == [1]


def test_wav_header():
    import io
    import wave

    from tallyspan.llm.media import wav

    with wave.open(io.BytesIO(wav(bytes(128)))) as f:
        assert (f.getnchannels(), f.getsampwidth(), f.getnframes()) == (1, 1, 128)


# --- class bigrams


def test_brown_base_scores_and_counts(docs, nothing):
    from tallyspan.llm.brown import class_bigram_scores

    held = lambda d: d is None or zlib.crc32(str(d).encode()) % 10 == 0
    words = lambda t: raw(t).lower().split() + [b""]
    c = Counter(w for d, t, *_ in TEXTS if not held(d) for w in words(t))
    n, v = sum(c.values()), len(c)
    for options in ({}, {"head": 3, "core": 2, "middle": 1, "classes": 2}):
        got = class_bigram_scores(docs, **options).collect()
        assert len(got) == len(TEXTS)
        want = Counter((d, held(d), len(words(t)), sum(w in c for w in words(t)), n, round(sum(log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t)), 4)) for d, t, *_ in TEXTS)
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
        assert all(r.score < 0 for r in got)
    assert class_bigram_scores(nothing).count() == 0


def test_brown_probabilities_add_up(spark):
    """Over all known words and one unknown, after any word, to one."""
    from tallyspan.llm.brown import END, fit, form

    rng = np.random.default_rng(3)
    texts = [(" ".join(rng.choice([f"w{i}" for i in range(30)] + ["Ab-c", "é"], 20)),) for _ in range(40)]
    model, counts = fit(spark.createDataFrame(texts, "text string"), core=10, middle=5, classes=3, head=20)
    step = model.transitions(0.1)
    known = np.zeros(len(step))
    for r in counts.collect():
        w = bytes(r.word)
        k = model.classes[model.head[w]] if w in model.head else model.n_classes + 1 + form(w)
        known[k] += (r.c - 0.6) / model.class_tokens[k]
    unknown, of_form = model.unknown(0.1, 0.6)
    assert np.allclose(step @ known + unknown * of_form.sum(), 1, atol=1e-9)
    assert np.allclose(step.sum(1), 1) and model.classes[model.head[END]] == model.n_classes and (unknown > 0).all()


@pytest.mark.parametrize("options", [{}, {"head": 12, "core": 6, "middle": 3, "classes": 3}])
def test_brown_scores_equal_a_plain_model(docs, spark, options):
    """Scores and perplexity from counts made here of classes that were fitted:
    P(class | class before) * P(word | class), word by word."""
    from tallyspan.llm.brown import END, fit, form, score

    learn = docs.where("doc_id > 4")
    model, counts = fit(learn, **options)
    words = lambda t: raw(t).lower().split() + [END]
    train = [words(t) for d, t, *_ in TEXTS if d is not None and d > 4]
    c = Counter(w for t in train for w in t)
    assert {bytes(r.word): r.c for r in counts.collect()} == c
    k = model.n_classes
    of = lambda w: int(model.classes[model.head[w]]) if w in model.head else k + 1 + form(w)
    steps, mass, known, shapes = Counter(), Counter(), Counter(), Counter(form(w) for w in c if w)
    for t in train:
        before = k
        for w in t:
            steps[before, of(w)] += 1
            before = of(w)
            mass[before] += 1
    for w in c:
        known[of(w)] += 1
    out = Counter(a for (a, _), n in steps.items() for _ in range(n))

    size, tokens = model.all_classes, sum(mass.values())

    def step(a, b):
        return (steps[a, b] + 0.1 * size * (mass[b] + 0.1) / (tokens + 0.1 * size)) / (out[a] + 0.1 * size)

    def total(t):
        before, at = k, 0.0
        for w in words(t):
            b = of(w)
            if w in c:
                at += log10(step(before, b) * (c[w] - 0.6) / mass[b])
            else:
                left = sum(step(before, x) * (0.6 * known[x] / mass[x] if mass[x] else 1) for x in range(size))
                at += log10(left * (shapes[form(w)] + 0.1) / (sum(shapes.values()) + 0.1 * 16))
            before = b
        return at

    got = Counter((r.doc_id, round(r.score, 6), round(log10(r.perplexity), 6)) for r in score(docs, model, counts).collect())
    assert got == Counter((d, round(total(t), 6), round(-total(t) / len(words(t)), 6)) for d, t, *_ in TEXTS)


def test_exchange_finds_planted_classes():
    from tallyspan.llm.brown import exchange

    k, c = 24, 3
    true = np.arange(k) // 8
    n = np.array([[50 if (true[i] + 1) % c == true[j] else 1 for j in range(k)] for i in range(k)])
    of = exchange(n, c)
    assert all(len({of[i] for i in range(k) if true[i] == t}) == 1 for t in range(c)) and len(set(of)) == c


# --- mixing


def test_mixing_budgets():
    from tallyspan.llm.mixing import budgets, share

    assert share(100, {"a": 1, "b": 3}, {"a": 1000, "b": 1000}) == {"a": 25, "b": 75}
    assert share(100, {"a": 1, "b": 3}, {"a": 1000, "b": 30}) == {"a": 70, "b": 30}
    assert share(100, {"a": 1, "b": 1}, {"a": 10, "b": 20}) == {"a": 10, "b": 20}
    held = {("x", "en", "1"): 10, ("x", "en", "2"): 1000, ("x", "de", "3"): 1000, ("y", None, "4"): 50}
    # The first leaf's shortage stays in its language, the last one's goes up.
    got = budgets(held, {("x",): 1, ("y",): 1, ("x", "en"): 3, ("x", "de"): 1}, 400)
    assert {k: round(v) for k, v in got.items()} == {("x", "en", "1"): 10, ("x", "en", "2"): 252, ("x", "de", "3"): 88, ("y", None, "4"): 50}
    assert budgets({}, {}, 10) == {}


@pytest.mark.parametrize("fraction, epochs, slices", [(0.5, 1, 4096), (0.5, 1, 1), (1.4, 2, 7), (1.0, 1, 16)])
def test_mixing_takes_prefixes(docs, nothing, fraction, epochs, slices):
    from tallyspan.llm.mixing import budgets, mix

    count = lambda t: len(raw(t).split())
    leaf = lambda s, g: ("d" if s is None else s, g, s)
    held = Counter()
    for d, t, g, s in TEXTS:
        held[leaf(s, g)] += count(t)
    want_of = budgets(dict(held), {("a",): 2.0}, fraction * sum(held.values()), epochs=epochs)
    want = Counter()
    for k, b in want_of.items():
        for e in range(epochs):
            left = min(max(b - e * held[k], 0), held[k])
            at = 0
            key = lambda x: (hashlib.md5(f"7:{e}|{'null' if x[0] is None else x[0]}".encode()).hexdigest(), x[1] or "")  # noqa: E731, B023
            # Texts of one id lie in one order key; TEXTS has no tie that splits.
            for d, t, *_ in sorted((x for x in TEXTS if leaf(x[3], x[2]) == k), key=key):
                if at < left - 1e-9:
                    want[d, t, e] += 1
                at += count(t)
    got = mix(docs, domain=F.coalesce("source", F.lit("d")), weights={("a",): 2.0}, fraction=fraction, epochs=epochs, slices=slices)
    have = Counter((r.doc_id, r.text, r.epoch) for r in got.collect())
    assert set(got.columns) >= {"doc_id", "text", "lang", "source", "tokens", "epoch", "leaf_budget", "key", "n"}
    if fraction < 1:
        odd = {(d, t) for d, t, _ in (have - want) + (want - have)}
        assert odd <= {(10, TEXTS[9][1]), (10, TEXTS[10][1]), (6, BASE)}  # ties of one id
    else:
        assert have == want
    assert mix(nothing, domain=F.lit("d")).count() == 0


def test_words_are_counted_like_split(spark):
    from tallyspan.llm.mixing import words_of

    texts = ["a b", " a\tb\n", "", None, "\x0b\x0c", "x\r\ny  z", "nb sp", LONG]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(words_of(F.col("t"))).collect()
    assert [r[0] for r in got] == [len(raw(t).split()) for t in texts]


# --- classifiers


def test_language(docs, nothing):
    from tallyspan.llm.langid import fit, predict

    got = predict(docs, fit(docs)).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        assert 0 <= r.score <= 1 and r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.doc_id in (2, 3, 4, 9):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in {"en", "de", "fr"}
    assert predict(nothing, fit(nothing)).count() == 0
    assert {r.lang_pred for r in predict(docs, fit(nothing)).collect()} == {"und"}


def test_language_on_held_out(spark, sf_dir):
    from tallyspan.llm.queries import op7_language

    rows = op7_language(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_kernel_scores_are_the_kernel():
    from tallyspan.llm import langid

    n = 1 << 14
    x = np.zeros((2, n), np.uint8)
    for k, t in enumerate((b"abc abd", b"abc xyz")):
        langid.presence(t, x[k])
    x = x.astype(np.float32)
    model = langid.Model(["a"], np.ascontiguousarray(x.T), np.sqrt(x.sum(1)), np.eye(2, dtype=np.float32))
    k = model.scores(x)
    assert np.allclose(np.diag(k), 1) and abs(k[0, 1] - (x[0] * x[1]).sum() / np.sqrt(x[0].sum() * x[1].sum())) < 1e-6


def test_toxicity(spark, docs, nothing):
    from tallyspan.llm.toxicity import clean_rows, fit, score

    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 14)], "doc_id long, quality int, toxic int")
    got = score(docs, fit(docs, labels)).collect()
    assert len(got) == len(TEXTS) and not any(r.toxic for r in got)
    assert score(nothing, fit(nothing, labels)).count() == 0
    assert score(docs, fit(docs, labels.limit(0))).where("toxic").count() == 0

    rng = np.random.default_rng(5)
    plain = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(400):
        text = list(rng.choice(plain, 60))
        bad = i % 4 == 0
        for _ in range((1 + 11 * (i % 8 == 0)) if bad else 0):
            text.insert(int(rng.integers(60)), "Scum!")
        rows.append((i, " ".join(text), int(bad)))
    train = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit(train.drop("toxic"), train.select("doc_id", "toxic"))
    assert list(model.vocabulary)[: model.marked] == [b"scum"] and model.thresholds[0] <= model.thresholds[1]
    assert set(model.vocabulary) == {b"scum", *(w.encode() for w in plain)} and min(model.weights) < 0  # words of both signs
    got = {r.doc_id: r for r in score(train.select("doc_id", "text"), model).collect()}
    assert all(got[i].toxic == bool(b) for i, _, b in rows)
    assert got[0].expected_severity > got[4].expected_severity > got[1].expected_severity
    assert (got[0].severity, got[1].severity) == (2, 0)
    assert clean_rows(train, model).count() == 300


def test_kernel_ridge_equals_a_plain_solution():
    """The fitted scores are those of a ridge regression solved from n-gram sets,
    texts equal in their n-grams score alike, and one block or many agree."""
    from tallyspan.llm import langid

    rng = np.random.default_rng(6)
    kinds = {"aa": "abcd", "bb": "cdef", "cc": "mnop"}
    lang = [k for k in kinds for _ in range(14)]
    texts = ["".join(rng.choice(list(kinds[k] + " "), 30)).encode() for k in lang]
    n, ridge = 1 << 14, 0.1
    x = np.zeros((len(texts), n), np.uint8)
    for row, t in zip(x, texts):
        langid.presence(t, row)
    mark = np.array([i % 14 < 5 for i in range(len(texts))])
    packed = [np.packbits(r).tobytes() for r in x]
    models = [langid.solve(lang, packed, mark, n, ridge, block) for block in (512, 5)]

    places = [set(np.flatnonzero(r).tolist()) for r in x]
    kernel = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5
    marks = [p for p, m in zip(places, mark) if m]
    kmm = np.array([[kernel(a, b) for b in marks] for a in marks])
    knm = np.array([[kernel(a, b) for b in marks] for a in places])
    y = np.array([[1.0 if k == c else -1.0 for c in sorted(kinds)] for k in lang])
    # Ridge on Nystroem features is this system in the landmarks' coefficients.
    alpha = np.linalg.solve(knm.T @ knm + ridge * kmm, knm.T @ y)
    for m in models:
        assert m.langs == sorted(kinds)
        assert np.allclose(m.scores(x.astype(np.float32)), knm @ alpha, atol=2e-3)
        assert m.predict(texts, 7)[0] == [m.langs[i] for i in (knm @ alpha).argmax(1)]


def test_language_learns_from_bounded_rows(spark):
    from tallyspan.llm.langid import fit

    rows = [(i, f"{'xyz'[i % 3] * 5} word {i}", f"l{i % 3 if i < 900 else 3}") for i in range(910)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit(docs, per_lang=20, landmarks=5, most_langs=3)
    assert model.langs == ["l0", "l1", "l2"] and model.landmarks.shape[1] == 15
    model = fit(docs, most_rows=40, most_landmarks=8)
    assert model.langs == ["l0", "l1", "l2", "l3"] and model.landmarks.shape[1] == 8
    hashes = sorted((r.h, r.doc_id) for r in docs.where("lang = 'l1' and crc32(cast(doc_id as string)) % 5 != 0").select("doc_id", F.xxhash64("doc_id").alias("h")).collect())
    from tallyspan.llm.langid import presence

    one = fit(docs.where("lang = 'l1'"), per_lang=20, landmarks=5)
    want = np.zeros((5, 1 << 14), np.uint8)
    for row, (_, i) in zip(want, hashes):
        presence(rows[i][1].encode(), row)
    assert {r.tobytes() for r in want} == {c.astype(np.uint8).tobytes() for c in one.landmarks.T}


def test_smallest_hashes(spark):
    from tallyspan.llm.common import smallest_hashes

    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    want = [r.doc_id for r in df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(500).collect()]
    assert [r.doc_id for r in smallest_hashes(df, "doc_id", 500).collect()] == want
    assert [r.doc_id for r in smallest_hashes(df, "doc_id", 500, 10**7).collect()] == want
    assert smallest_hashes(df.limit(3), "doc_id", 500).count() == 3 and smallest_hashes(df.limit(0), "doc_id", 5).count() == 0


def ordinal_objective(w, theta, rows, grades, ridge=0.02):
    at = lambda z: 1 / (1 + np.exp(-z))
    total = 0.0
    for x, g in zip(rows, grades):
        above = [1.0, *(at(sum(w[i] for i in x) - t) for t in theta), 0.0]
        total += np.log(above[g] - above[g + 1])
    return total / len(rows) - ridge / 200 * float((np.array(w) ** 2).sum())


@pytest.mark.parametrize("top", [1, 2, 3])
def test_cumulative_link_is_at_its_optimum(top):
    """The objective, written out, rises in no direction from what is fitted, and
    thresholds are in order."""
    from tallyspan.llm.toxicity import fit_cumulative_link

    rng = np.random.default_rng(top)
    rows = [sorted(rng.choice(5, rng.integers(0, 4), replace=False).tolist()) for _ in range(300)]
    eta = np.array([sum([1.5, 0.5, -1.0, 0.0, 2.0][i] for i in x) for x in rows]) + rng.logistic(size=300)
    grades = np.digitize(eta, np.linspace(0.5, 2.5, top)).astype(np.int64)
    w, theta = fit_cumulative_link(rows, grades, 5)
    assert len(theta) == top and (np.diff(theta) > 0).all() and w[4] > w[1] > w[2]
    best = ordinal_objective(w, theta, rows, grades)
    for i in range(5 + top):
        for step in (-0.05, 0.05):
            p = np.concatenate([w, theta])
            p[i] += step
            assert ordinal_objective(p[:5], p[5:], rows, grades) < best + 1e-5


def test_toxicity_vocabulary_is_that_of_plain_counts(spark):
    """Marked words, then the words of surest odds of either sign, against counts in
    Python; ties by bytes, no more than most_terms."""
    from tallyspan.llm.toxicity import fit, words

    rng = np.random.default_rng(8)
    rows = [(i, " ".join(rng.choice(["vile"] * (i % 3 == 0) + [f"w{k}" for k in range(60)] + ["kind"] * (3 * (i % 3 > 0)), 30)), int(i % 3 == 0)) for i in range(300)]
    rows += [(900, "vile", None), (901, None, 0), (902, "", 1)]
    train = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit(train.drop("toxic"), train.select("doc_id", "toxic"), most_terms=25)
    count = [Counter(), Counter()]
    for _, text, bad in rows:
        if bad is not None:
            count[bad].update(set(words((text or "").encode())))
    n = [sum(b == k for _, _, b in rows) for k in (0, 1)]
    found = []
    for w in count[0] | count[1]:
        c, t = count[0][w] + 0.5, count[1][w] + 0.5
        odds = np.log(t / (n[1] + 1 - t)) - np.log(c / (n[0] + 1 - c))
        z = odds / np.sqrt(1 / t + 1 / c + 1 / (n[1] + 1 - t) + 1 / (n[0] + 1 - c))
        marked = t >= max(3, 0.01 * n[1]) + 0.5 and z >= 3 and odds >= 3
        if marked or t + c - 1 >= 5:
            found.append((not marked, -round(abs(z), 9), w))
    assert list(model.vocabulary) == [w for _, _, w in sorted(found)[:25]]
    assert model.marked == sum(not m for m, _, _ in found) and b"kind" in model.vocabulary and model.weights[model.vocabulary[b"kind"]] < 0


def test_toxicity_scores_by_the_formula(spark):
    from tallyspan.llm.toxicity import SHARES, Model, fit, score

    model = Model({b"bad": 0, b"vile": 1}, np.array([1.0, 2.0, 0.5, 0.25, 0.0, 0.0, 1.5]), np.array([1.0, 2.5]))
    texts = ["a bad day", "BAD, vile; bad!", "", None, "vile " + "x " * 2999, "fine"]
    got = {r.doc_id: r for r in score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[a-z0-9]+", (t or "").lower())
        hits = [x for x in w if x in ("bad", "vile")]
        share = len(hits) / max(1, len(w))
        eta = sum({"bad": 1.0, "vile": 2.0}[x] for x in set(hits)) + sum(v for s, v in zip(SHARES, model.weights[2:]) if hits and share >= s)
        p = [1 / (1 + np.exp(t - eta)) for t in (1.0, 2.5)]
        assert abs(got[i].expected_severity - sum(p)) < 1e-12 and abs(got[i].p_toxic - p[0]) < 1e-12
        assert (got[i].severity, got[i].toxic, got[i].n_words) == (sum(x >= 0.5 for x in p), p[0] >= 0.5, len(w))

    # Grades of labels are fitted as they are.
    rows = [(i, "w x y " + "mean " * (i % 4 > 0) + "cruel " * (i % 4 > 1) + "foul " * (i % 4 > 2), int(i % 4 > 0), i % 4) for i in range(400)]
    train = spark.createDataFrame(rows, "doc_id long, text string, toxic int, level int")
    model = fit(train.select("doc_id", "text"), train.select("doc_id", "toxic", "level"), grade="level")
    assert len(model.thresholds) == 3
    assert all(r.severity == r.doc_id % 4 for r in score(train.select("doc_id", "text"), model).collect())


# --- near duplicates


def brute_components(texts, size, percent):
    sets = {}
    for d, t in texts:
        w = raw(t).lower().split()
        sets[d] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def test_near_duplicates_edges(docs, nothing):
    from tallyspan.llm.minhash import near_duplicates

    got = near_duplicates(docs, words=4).collect()
    assert len(got) == len(TEXTS)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    want = brute_components([(d, t) for d, t, *_ in TEXTS if d not in (None, 10)], 4, 80)
    for d, w in want.items():
        assert all((r.n_shingles, r.component_id, r.kept) == w for r in by[d])
    assert by[7][0].component_id == 6 and by[2][0].n_shingles == 0 and by[None][0].component_id is None
    assert near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("block", [256, 8])
def test_near_duplicates_in_large_families(spark, block):
    """A family of edited copies around one text, chains, and short texts."""
    from tallyspan.llm.minhash import near_duplicates

    rng = np.random.default_rng(block)
    word = lambda: "v" + str(rng.integers(10**9))
    base = [word() for _ in range(150)]
    texts = []
    for i in range(90):
        own = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 12)):
            own[at] = word()
        texts.append(" ".join(own))
    chain = [word() for _ in range(200)]
    for i in range(25):
        texts.append(" ".join(chain[i * 3 : i * 3 + 100]))
    texts += [" ".join(word() for _ in range(int(n))) for n in rng.integers(1, 30, 40)] + ["one two", "one two", "One  TWO", "one"]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4, block=block).collect()}
    assert got == brute_components(rows, 4, 80)


def test_components_of_a_long_path(spark):
    from tallyspan.llm.components import components

    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(500, 501), (502, 501), (7, 7)], "u long, v long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500, 502: 500}


def test_bitmap_only_spares(spark):
    from tallyspan.llm.common import Bitmap, without_ids

    df = spark.createDataFrame([(i, str(i)) for i in range(100)] + [(None, "n")], "doc_id long, text string")
    ids = spark.createDataFrame([(3,), (50,), (None,)], "doc_id long")
    assert {3, 50} <= {r.doc_id for r in Bitmap(ids, "doc_id", bits=8).split(df, True).collect()}
    assert {r.doc_id for r in without_ids(df, ids, "doc_id").collect()} == {None, *range(100)} - {3, 50}


# --- order minhash


def spark_hash(*values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v if isinstance(v, bytes) else struct.pack("<i" if isinstance(v, np.int32) else "<q", v), h)
    return h


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_signatures(text, k=6, length=2, m=64):
    """All k-mers, numbered, sorted, and from each bin on the least ones."""
    if not text:
        return [0] * m
    bits = 33 - (m.bit_length() - 1)
    seen, order = Counter(), []
    for i in range(max(1, len(text) - k + 1)):
        h = (spark_hash(text[i : i + k].encode("utf-32-be")) >> 30) & ((1 << 33) - 1)
        c, seen[h] = seen[h], seen[h] + 1
        own, low = spark_hash(h, np.int32(c)) & ((1 << 33) - 1), (1 << bits) - 1
        order.append((h if not c else (own >> bits << bits) | max(own & low, h & low), i))
    order.sort()
    out = []
    for j in range(m):
        b = sum(h < j << bits for h, _ in order)
        taken = sorted((order[(b + q) % len(order)] for q in range(length)), key=lambda x: (x[1], x[0]))
        h = 42
        for x, _ in taken:
            h = xxhash.xxh64_intdigest(struct.pack("<q", x), h)
        out.append(h & 0xFFFFFFFF)
    return out


def test_signatures_of_long_and_repetitive_texts(spark):
    """Texts beyond what is sorted whole, with k-mers that return, and texts whose
    few different k-mers leave bins empty, equal those of all k-mers."""
    from tallyspan.llm.order_minhash import with_signatures

    rng = np.random.default_rng(9)
    prose = " ".join(rng.choice([f"wörd{i}" for i in range(300)], 4000))
    texts = [prose, prose[:3000], "ab" * 5000, "x" * 9000, "a", "short one", "12345678", "123456789", "\U0001f600 ünï " * 700, prose[:1600] + "a line that returns " * 300, "".join(map(chr, rng.integers(33, 0x3000, 2500)))]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for options in ({}, {"spare": 4}, {"k": 5, "length": 3, "signatures": 16}):
        own = {"k": options.get("k", 6), "length": options.get("length", 2), "m": options.get("signatures", 64)}
        got = {r.i: r.own for r in with_signatures(df, "text", "own", **options).collect()}
        for i, t in enumerate(texts):
            assert got[i] == brute_signatures(t, **own), (i, options)


def test_order_minhash(docs, nothing):
    from tallyspan.llm.order_minhash import compare_with_edited

    got = compare_with_edited(docs).collect()
    assert len(got) == len(TEXTS)
    line = sorted({(-(1 << 63) if d is None else d, signed(spark_hash(raw(t))), t or "") for d, t, *_ in TEXTS})
    by = {}
    for r in got:
        by.setdefault((-(1 << 63) if r.doc_id is None else r.doc_id, r.fingerprint), []).append(r)
    text = lambda s: "".join(f"{x:08x}" for x in s)
    like = lambda a, b: sum(x == y for x, y in zip(a, b)) / len(a)
    for i, (d, _, t) in enumerate(line):
        after = line[(i + 1) % len(line)][2]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = map(brute_signatures, (t, edited, after))
        for r in by[d, text(a)]:
            assert (r.n_chars, r.edited_sha256, r.edited_fingerprint) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), text(b))
            assert abs(r.near_edited - like(a, b)) < 1e-12 and abs(r.near_next - like(a, c)) < 1e-12
    assert len(by[6, text(brute_signatures(BASE))]) == 2
    assert compare_with_edited(nothing).count() == 0
    assert compare_with_edited(docs.where("doc_id = 1")).first().near_next == 1.0


def test_likeness_follows_edit_distance():
    rng = np.random.default_rng(2)
    base = [f"tok{i}" for i in rng.integers(0, 10**6, 400)]
    sig = lambda w: brute_signatures(" ".join(w))
    like = lambda a, b: sum(x == y for x, y in zip(sig(a), sig(b))) / 64
    assert like(base, base[:390] + ["new"] * 10) > like(base, base[:200] + [f"n{i}" for i in range(200)]) > 0
    assert like(base, base[200:] + base[:200]) < like(base, base[:390] + ["new"] * 10)
    # One changed letter in every third word leaves k-mers in common, and so does
    # one letter put into a text without white space.
    changed = [w[:-1] + "x" if i % 3 == 0 else w for i, w in enumerate(base)]
    assert like(base, changed) > 0.1
    plain = "".join(map(chr, rng.integers(97, 123, 3000)))
    own, more = brute_signatures(plain), brute_signatures(plain[:40] + "#" + plain[40:])
    assert sum(x == y for x, y in zip(own, more)) > 55
    short = "five words of equal length"
    assert sum(x == y for x, y in zip(brute_signatures(short), brute_signatures(short[:13] + "1234567890123"))) > 0


@pytest.mark.parametrize("seed", range(5))
def test_likeness_of_texts_of_one_line(seed):
    """Half of a line's repetitions replaced by another line's: as alike as by
    plain Order MinHash, with a permutation for each signature."""
    rng = np.random.default_rng(seed)
    first, second = ("".join(map(chr, rng.integers(97, 123, 50))) + "\n" for _ in range(2))
    a, b = first * 120, first * 60 + second * 60

    def plain(text, m=128):
        seen, kmers = Counter(), []
        for i in range(len(text) - 5):
            kmers.append((text[i : i + 6], seen[text[i : i + 6]]))
            seen[text[i : i + 6]] += 1
        h = np.array([xxhash.xxh64_intdigest(f"{k}|{c}") for k, c in kmers], dtype=np.uint64)
        out = []
        for _ in range(m):
            h = h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(12345)
            g = h ^ (h >> np.uint64(29))
            g = g * np.uint64(0xBF58476D1CE4E5B9)
            out.append(tuple(kmers[i] for i in sorted(np.argpartition(g, 1)[:2])))
        return out

    like = lambda x, y: sum(p == q for p, q in zip(x, y)) / len(x)
    mine, theirs = (like(brute_signatures(a, m=256), brute_signatures(b, m=256)), like(plain(a), plain(b)))
    assert abs(mine - theirs) <= 0.1, (mine, theirs)


# --- queries and pipeline


def test_sql_twins(spark, sf_dir):
    import duckdb

    from tallyspan.llm.queries import QUERIES
    from tallyspan.llm.sql import ORACLE_SQL

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    for name, sql in ORACLE_SQL.items():
        df = QUERIES[name](spark, sf_dir)
        want = con.execute(sql)
        cols = [d[0] for d in want.description]
        assert Counter(tuple(r) for r in want.fetchall()) == Counter(tuple(r) for r in df.select(*cols).collect())


def plain_grams(text):
    """Places of a text's n-grams, one by one."""
    data = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in raw(text))
    out = set()
    for n, spread in ((1, 2654435761), (2, 2246822519), (3, 3266489917)):
        for i in range(len(data) - n + 1):
            out.add(((int.from_bytes(data[i : i + n], "big") + 1) * spread & 0xFFFFFFFF) >> 18)
    return out


def test_pipeline_equals_a_plain_version(spark, sf_dir):
    """Each stage against a recomputation from its input, row by row: the fitted
    models' formulas, all pairs, the budgets' prefixes, the tokenizer."""
    import corpus_pipeline as p
    from tallyspan.llm import langid, toxicity
    from tallyspan.llm.mixing import budgets
    from tallyspan.llm.queries import mixture_weights

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cols, sizes, rows = docs.columns, [docs.count()], None
    for name, stage in p.STAGES[:4]:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, sf_dir)
        assert out.columns == cols
        rows = out.collect()
        kept = {r.doc_id for r in rows}
        assert len(kept) == len(rows) and all(before[r.doc_id] == r for r in rows)
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            want = set()
            for d, r in before.items():
                w = re.findall(rb"[a-z0-9\x80-\xff]+", bytes(c + 32 if 65 <= c <= 90 else c for c in raw(r.text)))
                hits = [model.vocabulary[x] for x in w if x in model.vocabulary]
                marked = sum(i < model.marked for i in hits)
                on = [len(model.vocabulary) + i for i, s in enumerate(toxicity.SHARES) if hits and marked / len(w) >= s]
                if sum(model.weights[i] for i in {*hits, *on}) < model.thresholds[0]:
                    want.add(d)
            assert kept == want and len(want) < len(before) and model.vocabulary
        if name == "language":
            model = langid.fit(docs)
            marks = [set(np.flatnonzero(c).tolist()) for c in model.landmarks.T]
            want = set()
            for d, r in before.items():
                if not any(map(str.isalpha, r.text or "")):
                    continue
                own = plain_grams(r.text)
                f = np.array([len(own & m) / (len(own) * len(m)) ** 0.5 for m in marks]) @ model.weights
                if model.langs[f.argmax()] in p.LANGUAGES and min(1, max(0, (f.max() + 1) / 2)) >= p.LEAST_LANGUAGE_SCORE:
                    want.add(d)
            assert kept == want
        if name == "near_duplicates":
            assert kept == {d for d, (_, _, k) in brute_components([(d, r.text) for d, r in before.items()], 5, 80).items() if k}
        if name == "mixing":
            dealt = lambda s: f"d{int(hashlib.md5(s.encode()).hexdigest()[0], 16) % 4}"
            leaf = lambda r: (dealt(r.source), r.lang, r.source)
            count = lambda r: len(raw(r.text).split())
            held = Counter()
            for r in before.values():
                held[leaf(r)] += count(r)
            want = set()
            for k, budget in budgets(dict(held), mixture_weights(), p.MIX_FRACTION * sum(held.values())).items():
                at = 0
                for r in sorted((r for r in before.values() if leaf(r) == k), key=lambda r: hashlib.md5(f"7:0|{r.doc_id}".encode()).hexdigest()):
                    if at < min(budget, held[k]):
                        want.add(r.doc_id)
                    at += count(r)
            assert kept == want and 0.85 * sum(held.values()) < sum(count(before[d]) for d in kept)
        docs = spark.createDataFrame(rows, docs.schema)
        sizes.append(len(rows))
    assert sizes[1] < sizes[0] and sizes[3] < sizes[2]
    packed = lambda df: Counter(tuple(r) for r in df.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect())
    last = p.STAGES[4][1](spark, docs, sf_dir).collect()
    check_packing(last, [(r.doc_id, r.text) for r in rows], 2048)
    whole = p.run(spark, sf_dir)
    check_packing(whole.collect(), [(r.doc_id, r.text) for r in rows], 2048)
    assert sum(packed(whole).values()) > 0


def test_pipeline_stages_on_odd_tables(spark, docs, nothing, sf_dir):
    """Nulls, repeated rows and clashing columns pass through every stage; an empty
    table gives an empty one; a stage may be called on a result not yet written."""
    import corpus_pipeline as p

    for name, stage in p.STAGES:
        assert stage(spark, nothing, sf_dir).count() == 0
        out = stage(spark, docs, sf_dir)
        rows = out.collect()
        if name == "packing":
            check_packing(rows, TEXTS, 2048)
            continue
        assert out.columns == docs.columns and rows
        assert not Counter(map(str, rows)) - Counter(map(str, docs.collect()))
        assert all((r.tokens, r.epoch, r.l0, r.key) == (1, 9, "z", "k") for r in rows)
        if name == "language":
            assert {2, 3, 4, 9}.isdisjoint(r.doc_id for r in rows)
        if name == "near_duplicates":
            ids = Counter(r.doc_id for r in rows)
            assert ids[None] == 1 and ids[6] == 2 and ids[7] == 0
    (_, near), (_, mixing) = p.STAGES[2:4]
    lazy = near(spark, docs, sf_dir)
    assert mixing(spark, lazy, sf_dir).count() > 0 and lazy.count() > 0


def test_operators_ship_this_package(tmp_path):
    """The first call of an operator works where the executors' Python knows
    neither the driver's path nor its folder."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from tallyspan.session import build_session
spark = build_session("ship", master="local[2]", shuffle_partitions=2)
df = spark.createDataFrame([(1, "a b c", "en", "s")], "doc_id long, text string, lang string, source string")
from tallyspan.llm.packing import pack
assert pack(df).count() == 1
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": "/opt/tokenizers" if os.path.isdir("/opt/tokenizers") else ""}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=180)


def test_rest_stands_without_this_package(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", ".pytest_cache"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') for n in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", check=True, timeout=120)


def test_brown_exchange_reaches_words_beyond_the_core(spark):
    """Words far below core and middle, all of one form, are told apart by their
    neighbours, and likelihood rises over classes of form."""
    from tallyspan.llm.brown import fit

    rng = np.random.default_rng(5)
    kinds = [[f"{c}{i:02d}x" for i in range(40)] for c in "abc"]
    texts = [(" ".join(str(rng.choice(kinds[(j + s) % 3])) for j in range(30)),) for s in rng.integers(0, 3, 400)]
    model, _ = fit(spark.createDataFrame(texts, "text string").repartition(3), core=12, middle=6, classes=3)
    found = [Counter(int(model.classes[model.head[w.encode()]]) for w in kind) for kind in kinds]
    assert all(max(f.values()) >= 38 and max(f) < 3 for f in found)
    assert len({f.most_common(1)[0][0] for f in found}) == 3


def test_packing_keeps_targets_of_many_sources(spark):
    """The least of 80 sources is the only target, so it fills the first windows;
    without targets each source holds its share of every stretch."""
    from tallyspan.llm.packing import pack

    texts = [(i, "one two three four five six seven " * (8 if i % 80 else 6), None, f"s{i % 80:02d}") for i in range(800)]
    docs = spark.createDataFrame(texts, SCHEMA).repartition(3)
    pieces = pack(docs, length=64, targets={"s00": 1.0, "absent": 2.0, "s01": 0.0}).collect()
    last = max(r.sequence_id for r in pieces if r.source == "s00")
    assert all(r.source == "s00" for r in pieces if r.sequence_id < last) and len({r.doc_id for r in pieces}) == 800
    pieces = pack(docs, length=2048, runs=2048).collect()
    full = Counter((r.sequence_id, r.source) for r in pieces)
    assert all(full[w, f"s{s:02d}"] for w in range(max(r.sequence_id for r in pieces)) for s in range(80))


def test_windows_keep_to_targets_in_long_runs(spark):
    """Up to where the first queue ends, each source's tokens stay within a
    quantum for each level of the tree of its share, window by window; documents
    are cut into few pieces."""
    from tallyspan.llm.packing import pack

    rng = np.random.default_rng(4)
    texts = [(i, "word " * int(rng.integers(50, 900)), None, f"s{min(i % 30, 19):02d}") for i in range(1500)]
    docs = spark.createDataFrame(texts, SCHEMA).repartition(4)
    weight = lambda s: 1.0 + int(s[1:]) % 4
    pieces = pack(docs, targets=weight).collect()
    assert len(pieces) < 5 * len(texts)
    check_packing(pieces, texts, 2048)
    names = sorted({r.source for r in pieces})
    tokens = Counter()
    for r in pieces:
        tokens[r.source] += r.length
    whole = sum(map(weight, names))
    ended = min(tokens[s] * whole / weight(s) for s in names)
    spent, at = Counter(), 0
    for w in range(int(ended // 2048) - 1):
        for r in pieces:
            if r.sequence_id == w:
                spent[r.source] += r.length
        at += 2048
        assert all(abs(spent[s] - at * weight(s) / whole) <= 256 * 5 for s in names), w
