"""The core's operators against stated results and brute force."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from lexaudit import domains, lexicon
from lexaudit.functions import dates, htmltree, htmlx, jsonx, text, urls
from lexaudit.operators import dedup, fuzzy, rules, scoring, spans, timestamps, verdict
from lexaudit.sources import files


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).collect()[0].y


# problem 6

CASES = [
    ("25/04/2023 21:57", "a", "2023-04-25 14:57:00"), ("Jan 16, 2023 12:54 AM", "a", "2023-01-15 17:54:00"), ("2025-10-12 03:15:01+00", None, "2025-10-12 03:15:01"),
    ("20230611T092805Z", None, "2023-06-11 09:28:05"), ("1695188567098", None, "2023-09-20 05:42:47"), ("Rabu (24/4/2024) 01.26", "a", "2024-04-23 18:26:00"),
    ("Sat, 08 Mar 2025 04:51:21 +0900", None, "2025-03-07 19:51:21"), ("Rabu, 22 Maret 2023 | 11.04 WIB", "n", "2023-03-22 04:04:00"), ("18-3-25", "a", "2025-03-17 17:00:00"),
    ("30-04-2024, pukul 03.17 WITA", None, "2024-04-29 19:17:00"), ("2 Agt 2023, 09:40", "a", "2023-08-02 02:40:00"), ("2024-03-10 02:08:16", "n", None), ("2024-11-03 01:30", "n", "2024-11-03 05:30:00"),
    ("29 Februari 2023 08:10 WIB", "a", None), ("31/06/2024 10:00", "a", None), ("Mei 2024", "a", None), ("12/2024", "a", None), ("kemarin", "a", None), ("", "a", None), (None, "a", None), ("2024-01-01 10:00", None, None),
    ("0000-00-00 00:00:00", "a", None), ("2025-06-27T05:27:30.999554+07:00", None, "2025-06-26 22:27:30"), ("2024-01-01 10:00 XYZ", "a", None), ("x" * 5000, "a", None), ("2024-01-01T25:00:00Z", None, None), ("2024-12-17T21:12:45-0500", None, "2024-12-18 02:12:45"),
]


def test_timestamps(spark):
    d = spark.createDataFrame([(i, s, z) for i, (s, z, _) in enumerate(CASES)], "id int, d string, source_key string")
    zones = spark.createDataFrame([("a", "Asia/Jakarta"), ("n", "America/New_York")], "source_key string, zone string")
    got = {r.id: r.utc_epoch for r in timestamps.normalize_timestamps(d, "d", zones).collect()}
    want = {i: None if w is None else int(dt.datetime.fromisoformat(w + "+00:00").timestamp()) for i, (_, _, w) in enumerate(CASES)}
    assert got == want
    assert timestamps.normalize_timestamps(d.where("id < 0"), "d", zones).count() == 0


def test_zone_estimate(spark):
    rows = [("s", 1_700_000_000 + 7 * 3600 + i * 86400, None, 1_700_000_000 + i * 86400) for i in range(20)] + [("t", 1_700_000_000 + 9 * 3600, 1_700_000_100, None), (None, 1, 1, 1), ("u", 1_700_000_000, None, None)]
    v = spark.createDataFrame(rows, "source_key string, ts_local bigint, ingested bigint, stated bigint")
    z = {r.source_key: (r.zone, r.violations) for r in timestamps.estimate_zones(v, ["UTC", "Asia/Jakarta", "Asia/Jayapura"]).collect()}
    assert z == {"s": ("Asia/Jakarta", 0), "t": ("Asia/Jayapura", 0), "u": (None, 0)}  # u has no evidence


# text


def test_text_functions(spark):
    assert one(spark, "  A–b  “C”\n\td ", text.normalize) == 'a-b "c" d'
    assert one(spark, None, text.normalize) == "" and one(spark, None, text.word_count) == 0
    assert one(spark, " a b c\n", text.word_count) == 3
    assert one(spark, "x ADVERTISEMENT y Halaman 2 dari 3 z", text.clean) == "x y z"
    assert one(spark, "a\nBaca juga: b\n\nc", text.clean_lines) == "a\nc"
    assert one(spark, "b" * 900 + " bandung " + "c" * 900, lambda c: F.length(text.truncate_around(c, "bandung"))) == 800 + len("\n\n...\n\n") + 101 + 350
    assert one(spark, "Kalimat pertama yang panjang. Kalimat kedua juga panjang sekali.", text.summary) == "Kalimat pertama yang panjang. Kalimat kedua juga panjang sekali."
    assert one(spark, "pendek", text.summary) == ""


@pytest.mark.parametrize(("s", "n"), [("Rp 1.500.000", 1_500_000), ("senilai Rp 2,5 juta", 2_500_000), ("total 3 miliar dan rp5000", 3_000_000_000), ("", 0), ("rp 081234567890", 0), ("Rp 1o0", 100), ("rp 99999999999999", 0)])
def test_amounts(spark, s, n):
    assert one(spark, s, text.highest_amount) == n


def test_lexicon(spark):
    t = "serikat pekerja menolak pengurangan karyawan dan pengurangan jam kerja; upah minimum, k3"
    import re

    want = sum(bool(re.search(p, t)) for n in ("labour_positive", "labour_negative", "labour_issue") for p in lexicon.patterns(n))
    assert one(spark, t, lambda c: lexicon.hit_count(c, "labour_positive", "labour_negative", "labour_issue")) == want > 3
    assert one(spark, None, lambda c: lexicon.hit_count(c, "labour_issue")) == 0
    for n in lexicon.SETS:
        for p in lexicon.patterns(n):
            assert re.compile(p) and lexicon.stem(p) in p
    lexicon.add_set("own", [r"\bkopi\b"])
    assert one(spark, "harga kopi", lambda c: lexicon.any_of(c, "own"))


@pytest.mark.parametrize(("t", "host", "n"), [
    # anchor 40, one topic 20, elsewhere beside an anchor -15, anchor and topic 10
    ("kota bandung dan jakarta: phk massal", "", 55),
    # the word alone 20, one topic 20, elsewhere -60
    ("berita bandung dan jakarta: phk massal", "", 0),
    # district 30, three topics 40, host 10
    ("coblong: phk, pesangon, upah minimum", "www.kompas.com", 80),
    # whole words only: neither a place nor a topic
    ("coblongan phknya bandungan", "", 0),
    # landmark 35, noise beside fewer than two topics -25
    ("gasibu ramai, piala dunia", "", 10),
])
def test_tiered_score_by_hand(spark, t, host, n):
    d = spark.createDataFrame([(t, host)], "t string, h string")
    assert d.select(scoring.tiered(F.col("t"), F.col("h")).alias("y")).collect()[0].y == n


def test_domain_rules_by_hand(spark):
    c = domains.Columns()
    rows = [
        ("harga beras naik, stok kota bandung aman", "u"), ("harga beras dan stok di subang", "u"), ("mahasiswa menanam padi", "u"), ("ekspor kopi kota bandung dan mahasiswa", "u"), ("Jadwal salat".lower(), "u"),
        ("yayasan di kota bandung dan mahasiswa", "u"), ("laporan", "https://a.example/x.pdf?y=1"), ("warga andir", "u"),
    ]
    d = spark.createDataFrame(rows, "t string, u string")
    t, u = F.col("t"), F.col("u")
    found = d.select(domains.preflight(domains.TRADE, t, u, F.concat_ws(" ", t, u), c).alias("p"), domains.preflight(domains.NONPROFIT, t, u, F.concat_ws(" ", t, u), c).alias("q"), domains.lexical(domains.TRADE, t, c).alias("x"), domains.lexical(domains.NONPROFIT, t, c).alias("y"))
    assert [tuple(r) for r in found.collect()] == [
        ("pass", "pass", "topic", "poor"), ("elsewhere", "elsewhere", "no place", "elsewhere"), ("noise", "noise", "no place", "noise"), ("pass", "noise", "topic", "noise"), ("no news", "no news", "no place", "no place"),
        ("noise", "pass", "noise", "topic"), ("document", "document", "no place", "no place"), ("pass", "pass", "poor", "poor"),
    ]
    assert {n: len(lexicon.SETS[n]) for n in ("work_elsewhere", "work_noise", "trade_elsewhere", "trade_noise", "trade_districts")} == {"work_elsewhere": 33, "work_noise": 40, "trade_elsewhere": 81, "trade_noise": 81, "trade_districts": 34}


def test_selector_chains():
    page = '<html><head><title>T</title><meta property="og:title" content=" Judul "></head><body><h1> Kepala <b>berita</b></h1><div class="x post-content"><p>Satu</p><a href="#">tautan</a><p>dua <i>tiga</i></p><script>x</script></div><div id="d"></div></body></html>'
    assert htmltree.first_match(page, ['meta[property="og:title"]', "title"]) == "Judul"
    assert htmltree.first_match(page, ["h2", "h1"]) == "Kepalaberita"
    assert htmltree.first_match(page, ["div#d", "title"]) == ""  # an empty fit ends the search
    assert htmltree.first_match(page, ["p:first", "div.post-content p"]) == "Satu"
    assert htmltree.first_match(page, ["div.x a"], "href") == "#"
    assert htmltree.layered(page) == ("Kepala" + "berita", "Satu dua tiga")
    assert htmltree.layered("") == ("Tanpa Judul", "") and htmltree.first_match("", ["p"]) == ""
    deep = "<div>" * 5000 + "x"
    assert htmltree.first_match(deep, ["div"]) == "x"


def test_verdicts_in_batches(spark):
    def model(texts):
        if any("rusak" in t for t in texts):
            raise ValueError("no answer")
        return [t.upper() if t != "diam" else None for t in texts]

    d = spark.createDataFrame([(1, "a"), (2, "rusak"), (3, None), (4, ""), (5, "diam"), (6, "b")], "id bigint, t string")
    got = {r.id: r.verdict for r in verdict.in_batches(d, "id", "t", model, size=3).collect()}
    assert got == {1: "A", 2: "Unknown", 3: "Unknown", 4: "Unknown", 5: "Unknown", 6: "B"}


def test_urls(spark):
    assert one(spark, "https://A.b/x?c=1&d=&page=2", lambda c: urls.all_pages(c, ["a.b"])) == "https://A.b/x?c=1&page=all"
    assert one(spark, "https://a.b/x/page/3", urls.first_page) == "https://a.b/x?page=all"
    assert one(spark, "https://n.x/rss/articles/CBMiPWh0dHBzOi8vSnVybmFsa2FrdW5hcnNhLkV4YW1wbGUvYmVyaXRhP2thbmFsPW5pYWdhJmlkPTEwMDExNDPSAQA", urls.decode_feed) == "https://Jurnalkakunarsa.Example/berita?kanal=niaga&id=1001143"
    assert one(spark, "https://n.x/articles/%%%", urls.decode_feed) == "https://n.x/articles/%%%"
    assert one(spark, None, urls.host) == "" and one(spark, "https://a.b/c.PDF?x", lambda c: urls.is_document(c, [".pdf"]))


def test_dates(spark):
    assert one(spark, "Senin, 5 Mei 2025 10:20 WIB", dates.iso_text) == "2025-05-05 10:20:00"
    assert one(spark, "2024-07-29T02:59:46+07:00", dates.iso_text) == "2024-07-29 02:59:46"
    assert one(spark, "kira-kira 2024-02-30 itu", dates.iso_text) == "2024-02-30" and one(spark, None, dates.iso_text) == ""
    assert one(spark, "dibuat 5 mei 2024", dates.post_date) == "2024-05-05" and one(spark, "May 7, 2024", dates.post_date) == "2024-05-07"


def test_json_and_html(spark):
    answer = 'Baik: ```json\n{"a": "}"}\n``` selesai'
    assert json.loads(one(spark, answer, jsonx.robust_object)) == {"a": "}"}
    assert one(spark, 'x {"a": {"b": "}"}} y', jsonx.robust_object) == '{"a": {"b": "}"}}' and one(spark, "tidak ada", jsonx.robust_object) is None
    tree = json.dumps({"shortcode": "s", "node": {"taken_at": 5, "caption": {"text": "isi"}}, "x": [{"shortcode": "t", "taken_at": 6}]})
    assert sorted((p.code, p.at, p.caption) for p in one(spark, tree, jsonx.walk_posts)) == [("s", 5, "isi"), ("t", 6, None)]
    assert one(spark, "{", jsonx.walk_posts) == []
    p = one(spark, "<title>T</title><h1>Judul</h1><p>Satu <b>dua<p>tiga<script>x</script><img src=a><img src=a><a rel=tag href=/k>kop</a>", htmlx.parse_page)
    assert (p.title, p.body, p.images, p.tags) == ("Judul", "Satu dua tigakop", ["a"], ["kop"])
    assert one(spark, None, htmlx.parse_page).title == "Tanpa Judul"


# operators


def test_scores(spark):
    t = "pemkot bandung buka lowongan kerja, rekrutmen dan bursa kerja"
    assert one(spark, t, lambda c: scoring.tiered(c, F.lit("www.kompas.com"))) == 100
    assert one(spark, "kabupaten bandung", lambda c: scoring.tiered(c, F.lit(""))) == 0
    assert one(spark, None, lambda c: scoring.tiered(c, F.lit(None).cast("string"))) == 0
    assert one(spark, "detik.com", scoring.credibility_score) == 1.0 and one(spark, None, scoring.credibility_score) == 0.3
    assert one(spark, "phk massal", verdict.rule).employment == "2 Turun" and one(spark, "cuaca", lambda c: verdict.classify(c)).employment == "Unknown"


def test_sweep_and_spans(spark):
    def plain(s):
        kept = []
        for x in sorted(s, key=lambda x: (x[0], -(x[1] - x[0]))):
            if not kept or x[0] >= kept[-1][1]:
                kept.append(x)
            elif x[1] - x[0] > kept[-1][1] - kept[-1][0]:
                kept[-1] = x
        return kept

    rnd = random.Random(9)
    rows = [(i, [(a, a + rnd.randrange(1, 9)) for a in (rnd.randrange(30) for _ in range(rnd.randrange(0, 9)))]) for i in range(80)]
    rows = [(i, [list(x) for x in dict.fromkeys(s)]) for i, s in rows]
    d = spark.createDataFrame([(i, [tuple(x) for x in s]) for i, s in rows], "i int, s array<struct<start:int,stop:int>>")
    got = {r.i: [tuple(x) for x in r.s] for r in d.select("i", spans.sweep(F.col("s")).alias("s")).collect()}
    assert got == {i: plain([tuple(x) for x in s]) for i, s in rows}
    t = spark.createDataFrame([(1, "Upah buruh, upahnya upah"), (2, None)], "id bigint, text string")
    assert sorted((r.start, r.stop) for r in spans.find_spans(t, [("p", "upah")]).collect()) == [(0, 4), (20, 24)]


def test_dedup(spark):
    rows = [(1, "u1", "t1"), (2, "u2", "t1"), (3, "u2", "t3"), (4, None, None), (5, None, "t3"), (6, "u9", None)]
    d = spark.createDataFrame(rows, "o bigint, a string, b string")
    assert sorted(r.o for r in dedup.greedy_two_keys(d, "a", "b", "o").collect()) == [1, 3, 4, 6]
    rnd = random.Random(8)
    rows = [(i, f"u{rnd.randrange(25)}", f"t{rnd.randrange(25)}") for i in range(60)]
    seen_a, seen_b, want = set(), set(), []
    for o, a, b in rows:
        if a not in seen_a and b not in seen_b:
            want.append(o)
            seen_a.add(a)
            seen_b.add(b)
    assert sorted(r.o for r in dedup.greedy_two_keys(spark.createDataFrame(rows, "o bigint, a string, b string"), "a", "b", "o").collect()) == want
    seen = spark.createDataFrame([("u1",), ("u1",), (None,)], "a string")
    assert sorted(r.o for r in dedup.unseen(d, seen, "a").collect()) == [2, 3, 4, 5, 6]
    assert rules.tally(d, rules.first_reason([(F.col("a") == "u2", "x")], "y")).where("reason = 'x'").collect()[0].n == 2


def test_common_length_against_the_table():
    rnd = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rnd.choice("abcd ") for _ in range(rnd.randrange(0, 80))) for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                t[i][j] = t[i - 1][j - 1] + 1 if x == y else max(t[i - 1][j], t[i][j - 1])
        assert fuzzy.common_length(a, b) == t[-1][-1]


def test_fuzzy(spark):
    left = spark.createDataFrame([(1, "PT Maju Jaya"), (2, "zzz"), (3, None)], "id bigint, name string")
    right = spark.createDataFrame([(9, "maju jaya pt"), (8, "PT Maju"), (7, "CV Lain")], "id bigint, name string")
    assert [(r.left_id, r.right_id, r.score) for r in fuzzy.best_matches(left, right).collect()] == [(1, 8, 100.0)]
    assert fuzzy.token_set_ratio("a b", "a c") == pytest.approx(66.67, abs=0.01)


def test_files(spark, tmp_path):
    d = spark.createDataFrame([(1, "a")], "n int, s string")
    for end in ("parquet", "json", "csv"):
        files.export(d, str(tmp_path / f"x.{end}"), {"s": "nama"}, ["nama"])
        assert files.read_any(spark, str(tmp_path / f"x.{end}")).columns[0] in ("nama", "n")
    (tmp_path / "u.txt").write_text(" a \n\nb\n")
    assert [r.url for r in files.read_addresses(spark, str(tmp_path / "u.txt")).collect()] == ["a", "b"]
    (tmp_path / "c1.json").write_text('[{"n": 1}, {"n": 2}]')
    (tmp_path / "c2.json").write_text("kaput {")
    assert sorted(r.n for r in files.read_checkpoints(spark, str(tmp_path / "c*.json"), "n int").where("n IS NOT NULL").collect()) == [1, 2]
    assert one(spark, "audit_20250102_030405.json", lambda c: files.file_time(c).cast("string")) == "2025-01-02 03:04:05" and one(spark, "x", lambda c: files.in_range(c, "1", "2"))


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
