"""BPE by speculation, executed compaction and the filter audit against brute force."""

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from itertools import permutations
from math import floor

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspan.llm import audit, compaction
from tallyspan.llm.bpe import Coder, decode, encode

# --- BPE


@pytest.fixture(scope="module")
def plain():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def own():
    import public_tokenizers

    return Coder(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(coder, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)]


ODD = [
    "", " ", "a", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endoftext|", "don't  we'll\n\n\t x", "naïve 中文文本 İstanbul 😀👍🏽", "\u0000�​   ",
    "a" * 5000, "  " * 3000 + "x", "=" * 700 + "-" * 300, "qwertyuiopzxcv" * 40, "1234567890" * 30,
]


def test_bpe_equals_the_library(spark, plain, own):
    assert ids_of(own, ODD) == [e.ids for e in plain.encode_batch(ODD, add_special_tokens=False)]
    rows = [(i, t, "x", [1]) for i, t in enumerate([*ODD, None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<int>").repartition(3)
    got = {r.doc_id: r for r in decode(encode(docs)).collect()}
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "decoded", "ids"}
    for i, t, *_ in rows:
        want = plain.encode(t or "", add_special_tokens=False).ids
        assert got[i].ids == want and got[i].decoded == plain.decode(want, skip_special_tokens=False) == (t or "")
    assert encode(docs.limit(0)).count() == 0
    odd = decode(spark.createDataFrame([(1, None), (2, [50256, 999999, None, 160])], "k int, ids array<int>"), out="text")
    assert {r.k: r.text for r in odd.collect()} == {1: None, 2: plain.decode([50256, 160], skip_special_tokens=False)}


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="abest nor'\n 12", max_size=60)), max_size=6))
def test_bpe_fuzz(texts, plain, own):
    assert ids_of(own, texts) == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_pairs_are_judged_as_exact_merging_would(own):
    rnd = random.Random(5)
    some = sorted(own.ids.values())
    a, b = (np.array([rnd.choice(some) for _ in range(4000)]) for _ in "ab")
    near = [(i, j) for i, j in list(own.merges)[::25]]
    a, b = np.append(a, [x for x, _ in near]), np.append(b, [y for _, y in near])
    want = [own.merged(own.text_of[x] + own.text_of[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist())]
    assert own.compatible(a, b).tolist() == want and 0 < sum(want) < len(want)


def test_only_failing_words_are_merged(own, monkeypatch):
    own.seen, own.older, met = {}, {}, []
    exact = own.merged
    monkeypatch.setattr(own, "merged", lambda w: met.append(w) or exact(w))
    words = ["the", " house", " zanthe", " indistinguishable", " qqxzvb"]
    own.encode(words)
    assert set(met) == {w.encode() for w in words if own.propose(w.encode()) != exact(w.encode())}


def test_short_and_long_words_merge_alike(own):
    rnd = random.Random(2)
    for _ in range(300):
        word = "".join(rnd.choice("abcdetr =-") for _ in range(rnd.randint(0, 90))).encode()
        assert own.merged(word) == own._merged_long([own.byte_ids[b] for b in word])


def test_tables_of_words_stay_small(own, plain, monkeypatch):
    monkeypatch.setattr("tallyspan.llm.bpe.KEPT", 50)
    monkeypatch.setattr("tallyspan.llm.bpe.BLOCK", 200)
    own.seen, own.older = {}, {}
    texts = [" ".join(f"w{i * k % 97}x{i}" for i in range(k)) + "<|endoftext|>z" for k in range(1, 60)]
    assert ids_of(own, texts) == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_other_files_are_refused(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError, match="no plain byte-level BPE"):
        Coder(public_tokenizers.path("word_bpe_49k.json"))


# --- compaction


def brute_plan(rows):
    """Starting files, then the final files by their sources, by plain search."""
    total = len(rows)
    s = lambda x: 1 + total // x
    days = defaultdict(list)
    for r in rows:
        days[None if r["arrived_at"] is None else (r["arrived_at"] - datetime(1970, 1, 1)).days].append(r)
    final = {}
    for day, own in days.items():
        files = defaultdict(list)
        for r in own:
            h = zlib.crc32(("" if r["click_id"] is None else str(r["click_id"])).encode())
            files[h // 16 % (1 + len(own) // s(200)), min(h % 4, h // 4 % 4)].append(r)
        for f in files.values():
            f.sort(key=lambda r: (r["arrived_at"] or datetime.min, -1 if r["click_id"] is None else r["click_id"]))
        groups = []
        for place in sorted(files, key=lambda p: (-len(files[p]), p)):
            if len(files[place]) >= s(750):
                final[day, *place] = ([place], files[place])
                continue
            for g in groups:
                if sum(len(files[p]) for p in g) + len(files[place]) <= s(400):
                    g.append(place)
                    break
            else:
                groups.append([place])
        for g in groups:
            final[day, *g[0]] = (g, [r for p in g for r in files[p]])
    return final


def check_files(df, rows, columns):
    want, got = brute_plan(rows), {(r.day, r.lot, r.piece): r for r in df.collect()}
    assert set(got) == set(want)
    for k, (places, held) in want.items():
        r, ids = got[k], [x["click_id"] for x in held if x["click_id"] is not None]
        assert (r.n_rows, r.rewritten, r.columns) == (len(held), len(places) > 1, ",".join(columns))
        assert r.sources == ",".join(f"{a}-{b}" for a, b in places)
        assert (r.min_click_id, r.max_click_id) == (min(ids, default=None), max(ids, default=None))
        assert r.cents == sum(0 if x["value"] is None else floor(100 * x["value"] + 0.5) for x in held)
        text = ",".join("" if x["click_id"] is None else str(x["click_id"]) for x in held)
        assert r.ids_sha256 == hashlib.sha256(text.encode()).hexdigest()
        table = pq.read_table(r.path.removeprefix("file://"), partitioning=None)
        assert table.column_names == columns and table.column("click_id").to_pylist() == [x["click_id"] for x in held]
    folder = os.path.dirname(os.path.dirname(os.path.dirname(os.path.dirname(next(iter(got.values())).path.removeprefix("file:").replace("///", "/")))))
    on_disk = {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}
    assert on_disk == {r.path.removeprefix("file:").replace("///", "/") for r in got.values()}
    return got


def test_compaction_of_clicks_by_plain_search(spark, sf_dir):
    from tallyspan.llm.queries import op12_compaction

    rows = duckdb.sql(f"select click_id, arrived_at, value from '{sf_dir}/clicks.parquet'").to_arrow_table().to_pylist()
    columns = spark.read.parquet(f"{sf_dir}/clicks.parquet").columns
    got = check_files(op12_compaction(spark, sf_dir), rows, columns)
    assert {r.rewritten for r in got.values()} == {True, False}


def test_compaction_of_odd_rows(spark):
    start = datetime(2024, 1, 1, 23, 59, 59)
    rows = [(i, start + timedelta(hours=7 * (i % 9)), i / 3 if i % 5 else None, i) for i in range(900)]
    rows += [(None, start, 1.005, 1), (None, None, -0.005, 2), (7, start, 2.0, 3), (8, None, None, 4), (9, datetime(1969, 12, 31, 12), 1.0, 5)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, "click_id long, arrived_at timestamp_ntz, value double, day int").withColumn("lot", F.lit("x")).repartition(5)
    plain = [dict(zip(("click_id", "arrived_at", "value"), r)) for r in rows]
    got = check_files(compaction.written_and_compacted(df, at="arrived_at", key="click_id", value="value"), plain, df.columns)
    assert any(k[0] is None for k in got) and any(k[0] == -1 for k in got)
    assert compaction.written_and_compacted(df.limit(0), at="arrived_at", key="click_id", value="value").count() == 0


def test_untouched_files_stay_byte_for_byte(spark, sf_dir, tmp_path):
    df, folder = spark.read.parquet(f"{sf_dir}/clicks.parquet"), str(tmp_path / "t")
    n = df.count()
    compaction.write_files(df, folder, at="arrived_at", key="click_id", rows=n)
    before = {f: open(f, "rb").read() for f in (os.path.join(d, x) for d, _, names in os.walk(folder) for x in names) if f.endswith(".parquet")}
    done = compaction.compact(spark, folder, rows=n)
    after = {os.path.join(d, x) for d, _, names in os.walk(folder) for x in names if x.endswith(".parquet")}
    same = [f for f in after if f in before]
    assert all(open(f, "rb").read() == before[f] for f in same) and len(same) == done.where("files = 1").count() > 0
    assert spark.read.option("recursiveFileLookup", True).parquet(folder).count() == n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60), st.integers(1, 40))
def test_room_index_is_first_fit(sizes, most):
    groups, want = [], []
    for s in sizes:
        g = next((i for i, x in enumerate(groups) if sum(x) + s <= most), None)
        if g is None:
            groups.append([])
            g = len(groups) - 1
        want.append((g, len(groups[g])))
        groups[g].append(s)
    # A group that a too large size opened holds it alone; brute force agrees,
    # as long as zeros find no room in it.
    if all(s for s in sizes):
        assert compaction.first_fit(sizes, most) == want


# --- filter audit


def brute_audit(docs, labels):
    words = lambda t: [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t) if w]
    first, good, toxic = {}, set(), set()
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, q, x in labels:
        if i is not None:
            good |= {i} if q == 1 else set()
            toxic |= {i} if x == 1 else set()
    out = defaultdict(Counter)
    for p in {p or "" for _, _, p in docs}:
        for o in permutations("ABCDE"):
            for s in range(1, 6):
                out[p, "".join(o), s].update(dict.fromkeys(audit.COUNTS, 0))
    for i, t, p in docs:
        t, p = t or "", p or ""
        w = words(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > first[t]}
        for o in permutations("ABCDE"):
            gone = False
            for s, f in enumerate(o, 1):
                c = out[p, "".join(o), s]
                if not gone and not fails[f]:
                    c["kept"] += 1
                if fails[f]:
                    c["redundant" if gone else "removed"] += 1
                    c["unique_fails"] += sum(fails.values()) == 1
                    if not gone:
                        c["good_lost"] += i in good
                        c["toxic_lost"] += i in toxic
                gone |= fails[f]
    by = Counter()
    for (p, o, s), c in out.items():
        by[p, o[s - 1]] += c["removed"]
    for (p, o, s), c in out.items():
        c["shapley"] = by[p, o[s - 1]]
    return {k: tuple(c[x] for x in audit.COUNTS) for k, c in out.items()}


def test_filter_audit_by_plain_counting(spark):
    long = " ".join(f"w{i}" for i in range(210))
    docs = [
        (1, long, "en"), (2, long, "en"), (2, long, "en"), (1, long, "de"), (3, long + " 5%", "de"), (4, "w " * 300, "en"), (5, "SHOUT " + long, None), (6, "SHOUT LOUD & long", ""), (7, None, "fr"), (8, "", "fr"),
        (None, long, "en"), (None, "one off", "en"), (9, "one off", "en"), (10, "Ünï CÖDE 中文  x\ty\x0bz ", "fr"), (11, long.replace("w", "W"), "en"), (12, " \n", "fr"), (0, "x " * 200000, "en"), (-5, "one off", "en"),
    ]
    labels = [(1, 1, 0), (1, 0, 1), (4, 1, 1), (2, None, 1), (None, 1, 1), (6, 1, None), (99, 1, 1), (0, 0, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({"part": F.lit(1), "mask": F.lit("m"), "n": F.lit(5), "good": F.lit("g"), "digest": F.lit(2)}).repartition(4)
    got = audit.interactions(audit.document_failures(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in audit.COUNTS) for r in got} == brute_audit(docs, labels)
    assert len(got) == 4 * 600


def test_filter_audit_of_nothing(spark):
    d, l = spark.createDataFrame([], "doc_id long, text string, lang string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.interactions(audit.document_failures(d, l)).count() == 0


def test_matrices_are_of_whole_numbers():
    m = audit.outcome_matrices(5)
    assert {x.shape for x in m.values()} == {(32, 600)} and {x.dtype for x in m.values()} == {np.dtype("int64")}
    # Each document is, after the last step of an order, kept or removed once.
    last = np.arange(4, 600, 5)
    assert (m["kept"][:, last] + m["removed"].reshape(32, 120, 5).sum(axis=2) == 1).all()


def test_filter_audit_equals_its_sql(spark, sf_dir):
    from tallyspan.llm.queries import op13_filter_audit
    from tallyspan.llm.sql import ORACLE_SQL

    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    want = con.execute(ORACLE_SQL["op13_filter_audit"]).to_arrow_table().to_pylist()
    got = [r.asDict() for r in op13_filter_audit(spark, sf_dir).collect()]
    key = lambda r: (r["part"], r["filter_order"], r["step"])
    assert sorted(got, key=key) == sorted(want, key=key) and got
