"""The training-text operators against brute force, round trips and stated edge cases."""

import random

import pytest

pytest.importorskip("lexaudit.llm")

from pyspark.sql import functions as F  # noqa: E402

from lexaudit.llm import boilerplate, cutoffs, history, leaks, nearcopies, packing, repeats, residue, splitting  # noqa: E402
from lexaudit.llm.tokens import counter  # noqa: E402

A = "article_id bigint, batch_no int, url string, source string, title string, content string, `rank` int"


def articles(spark, rows):
    return spark.createDataFrame([(r.get("id"), r.get("batch", 1), r.get("url"), r.get("source"), r.get("title"), r.get("content"), 1) for r in rows], A)


def ids(df):
    return sorted(r[0] for r in df.collect())


# problem 1


def scored(spark, rows):
    return spark.createDataFrame(rows, "scored_id bigint, source string, total_score double, extra string")


def targets(spark, rows):
    return spark.createDataFrame(rows, "source string, keep_pct int")


def test_cutoffs_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["A", " a ", "b", "c"]), rnd.choice([0.1, 0.2, 0.5]) if i % 2 else rnd.random(), "x") for i in range(900)]
    t = {"a": 30, "b": 75, "c": 5}
    kept = set(ids(cutoffs.kept_records(scored(spark, rows), targets(spark, list(t.items())))))
    want = set()
    for s, pct in t.items():
        own = [(x, i) for i, q, x, _ in rows if q.strip().lower() == s]
        cut = max(x for x, _ in own if 100 * sum(y >= x for y, _ in own) >= pct * len(own))
        want |= {i for x, i in own if x >= cut}
    assert kept == want


def test_cutoffs_edges(spark):
    rows = [(1, "a", None, ""), (2, "a", float("nan"), ""), (3, None, 0.5, ""), (4, "a", 0.4, ""), (4, "a", 0.4, ""), (5, " ", 0.4, ""), (None, "a", 0.9, ""), (6, "zz", 0.1, "")]
    assert ids(cutoffs.kept_records(scored(spark, rows), targets(spark, [("A ", 50), ("b", None)]))) == [4]
    assert ids(cutoffs.kept_records(scored(spark, []), targets(spark, [("a", 50)]))) == []
    ties = [(i, "a", 0.5, "") for i in range(10)]
    assert len(ids(cutoffs.kept_records(scored(spark, ties), targets(spark, [("a", 10)])))) == 10


def test_cutoffs_closest(spark):
    rows = [(i, "a", i / 10, "") for i in range(10)]
    c = cutoffs.score_cutoffs(cutoffs.scored_records(scored(spark, rows)), targets(spark, [("a", 34)]), "closest").collect()
    assert [(r.cutoff, r.n_kept) for r in c] == [(0.7, 3)]


# problem 2

SAME = [
    "https://a.example/read/1000204/pasokan-teh", "http://www.a.example:443/read//1000204/lain-judul/?utm_source=x#top", "https://M.A.EXAMPLE/read/1000204/x/amp",
    "https://keluar.agregat.example/buka?u=https%3A%2F%2Fa.example%2Fread%2F1000204%2Fq&s=rss", " https://a.example/read/1000204/pasokan-teh ",
]


def test_same_story_addresses(spark):
    other = ["https://b.example/read/1000204/pasokan-teh", "https://a.example/read/1000205/pasokan-teh", "https://a.example/pasar/2024/03/15/e0032/satu", "https://a.example/pasar/2024/03/15/e0033/satu", "https://a.example/niaga/2024/03/15/e0032/satu", "https://a.example/pasar/2024/03/16/e0032/satu"]
    d = spark.createDataFrame([(u,) for u in SAME + other], "url string")
    t = [tuple(r.tokens) for r in history.with_story_tokens(d, "url").collect()]
    assert len(set(t[: len(SAME)])) == 1
    assert len(set(t)) == 1 + len(other)


def test_history_batches(spark):
    rows = [{"id": 1, "url": SAME[0]}, {"id": 2, "url": SAME[1]}, {"id": 3, "url": None}, {"id": 4, "url": ""}, {"id": 5, "batch": 2, "url": SAME[3]}, {"id": 6, "batch": 2, "url": "https://c.example/berita?kanal=x&id=7"}, {"id": 7, "batch": 3, "url": "https://c.example/berita/?id=7&kanal=y&fbclid=1"}, {"id": 8, "batch": 3, "url": "https://v.example/read/1000001/z"}]
    visited = spark.createDataFrame([("https://www.v.example/read/1000001/other",), (None,), (" ",)], "url string")
    assert ids(history.repeated_addresses(articles(spark, rows), visited)) == [2, 5, 7, 8]
    assert ids(history.repeated_addresses(articles(spark, []), visited)) == []


def test_history_threshold_below_one(spark):
    rows = [{"id": 1, "url": "https://a.example/x/2024/01/01/one/b/c/d/e"}, {"id": 2, "url": "https://a.example/x/2024/01/01/two/b/c/d/e"}, {"id": 3, "batch": 2, "url": "https://a.example/x/2024/01/01/three/b/c/d/e"}, {"id": 4, "batch": 2, "url": "https://a.example/y/2023/01/01/q"}]
    visited = spark.createDataFrame([("https://z.example/q",)], "url string")
    assert ids(history.repeated_addresses(articles(spark, rows), visited, 0.6)) == [2, 3]


# problem 3

STORY = [
    "Pemeriksaan atas koperasi itu menemukan banyak berkas yang keliru sejak awal pekan lalu.", "Jumlah pelamar untuk lowongan itu mencapai ratusan orang, sementara kuota hanya puluhan saja.",
    "Latar belakang", '"Kami minta semua pihak menahan diri lebih dulu," ujar ketua serikat kepada wartawan.', "• Kota Utara: 21 anyaman bambu, PT Contoh", "Rapat itu dihadiri pemasok, buruh harian, serta direktur operasional perusahaan.",
]


def test_main_body(spark):
    rows, names = [], "abu bari cici dodo eka fani gogo hana ika jono kiki lala".split()
    for i in range(12):
        own = [x if x == "Latar belakang" else x.replace(" ", f" {names[i]} ", 3) for x in STORY]
        lines = ["Home / Niaga / Berita", "Opini", "Gaya Hidup", *own[:3], "IKLAN", "Baca juga: Harga kopi naik lagi di pasar induk kota", *own[3:], "", "Opini | Gaya Hidup | Video", "Paling Banyak Dibaca", "1. Harga kain katun jauh membaik, mandor proyek mencabut sewa", "© 2024 Situs. Hak cipta dilindungi."]
        rows.append({"id": i, "source": "situs.example", "title": f"Judul {i}", "content": "\n".join(lines)})
    rows += [{"id": 90, "content": None}, {"id": 91, "content": ""}, {"id": 92, "content": "\n \n"}]
    found = boilerplate.split_pages(articles(spark, rows)).collect()
    content = {r["id"]: (r["content"] or "").split("\n") for r in rows}
    story = {content[r.article_id][r.line_no - 1] for r in found if r.in_story}
    assert {" ".join(w for w in x.split() if w not in names) for x in story} == set(STORY)
    assert {r.article_id for r in found} == set(range(12))


def test_density_decides_the_extent_of_the_story():
    known = boilerplate.Knowledge(frozenset(), frozenset(), frozenset())
    page = "\n".join(["Editor Kana", *STORY[:2], "Latar belakang", *STORY[3:], "Editor Kana"])
    assert boilerplate.story_lines(page, None, None, known)[1] == [1, 8]
    plain = boilerplate.density
    try:
        boilerplate.density = lambda *_: 1.0
        assert boilerplate.story_lines(page, None, None, known)[1] != [1, 8]
    finally:
        boilerplate.density = plain


# problem 4


def test_residue(spark):
    prose = "Pemerintah kota {} pelatihan kerja bagi warga di kecamatan itu sejak pekan lalu, ujar kepala dinas kepada wartawan."
    verbs = ["membuka", "menunda", "menutup", "meninjau", "membahas", "menambah"]
    rows = [{"id": i, "content": "\n".join(prose.format(v) for v in random.Random(i).sample(verbs, 3))} for i in range(60)]
    bad = ["Akses ditolak", "{{ judul }}\n%%isi%%", "undefined", "Please enable JavaScript", prose.format("«nama»"), prose.format("membuka") + "\nTeks pengisi sementara", "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore"]
    rows += [{"id": 100 + k, "content": x} for k, x in enumerate(bad)]
    rows += [{"id": 200, "content": None}, {"id": 201, "content": ""}, {"id": 202, "content": prose.format("membuka").replace("pelatihan kerja", "kelas JavaScript")}]
    assert ids(residue.residue_articles(articles(spark, rows))) == [100 + k for k in range(len(bad))]
    assert ids(residue.residue_articles(articles(spark, []))) == []


def test_residue_that_fails_often(spark):
    verbs = ["membuka", "menunda", "menutup", "meninjau", "membahas", "menambah"]
    prose = "Pemerintah kota {} pelatihan kerja bagi warga di kecamatan itu sejak pekan lalu, ujar kepala dinas kepada wartawan."
    page = lambda i: "\n".join(prose.format(v) for v in random.Random(i).sample(verbs, 5))
    bad = ["{{lead}}", "isi_berita: undefined", "Lorem ipsum dolor sit amet", "Teks pengisi sementara", "«nama»"]
    rows = [{"id": i, "source": f"s{i % 8}", "content": page(i)} for i in range(300)]
    # by one site, and by all of them
    rows += [{"id": 1000 + 10 * k + i, "source": "s0", "content": page(i) + "\n" + x} for k, x in enumerate(bad[:3]) for i in range(6)]
    rows += [{"id": 2000 + 10 * k + i, "source": f"s{i}", "content": page(i) + "\n" + x} for k, x in enumerate(bad[2:]) for i in range(6)]
    assert ids(residue.residue_articles(articles(spark, rows))) == sorted(r["id"] for r in rows if r["id"] >= 1000)


# problem 5


def test_repeated_lines_against_brute_force(spark):
    rnd = random.Random(5)
    notes = ["Hak cipta 2024", "HAK-CIPTA 2025!", "Bagikan", "Menu utama", "!!", ""]
    rows = [{"id": i, "source": rnd.choice(["x", " X", "y", None]), "content": None if i % 17 == 0 else "\n".join([f"kalimat {chr(97 + i % 26)}{chr(97 + i // 26)} unik", *rnd.sample(notes, 3), "Bagikan" if i % 3 else ""])} for i in range(150)]
    got = sorted((r.article_id, r.line_no) for r in repeats.repeated_lines(articles(spark, rows)).collect())
    key = lambda s: "".join(c for c in s.lower() if c.isalpha())
    by = {}
    for r in rows:
        if r["source"]:
            by.setdefault(r["source"].strip().lower(), []).append(r)
    want = []
    for own in by.values():
        docs = {}
        for r in own:
            for k in {key(x) for x in (r["content"] or "").split("\n")} - {""}:
                docs[k] = docs.get(k, 0) + 1
        want += [(r["id"], n) for r in own if r["content"] is not None for n, x in enumerate(r["content"].split("\n"), 1) if docs.get(key(x), 0) >= max(4, 0.03 * len(own))]
    assert got == sorted(want)


def test_blocks_and_cleaning(spark):
    rows = [{"id": i, "source": "s", "content": f"awal {'abcdefghij'[i]}\nsatu\ndua\ntiga\nakhir {'klmnopqrst'[i]}"} for i in range(10)]
    a = articles(spark, rows)
    lines = repeats.document_lines(a)
    shared = repeats.shared_lines(lines, 4, 3)
    blocks = repeats.repeated_blocks(repeats.line_runs(lines, shared), shared).collect()
    assert max(len(b.block) for b in blocks) == 3 and all(b.n_docs == 10 for b in blocks)
    kept = repeats.without_lines(a, repeats.repeated_lines(a)).collect()
    assert {r.content for r in kept} == {f"awal {'abcdefghij'[i]}\nakhir {'klmnopqrst'[i]}" for i in range(10)}


def test_blocks_count_documents_once(spark):
    # a block of two lines in four documents, each of which has it twice with other lines behind it
    texts = ["satu\ndua\ntiga\nsela {}\nsatu\ndua\nempat".format("abcd"[i] * 9) for i in range(4)]
    a = articles(spark, [{"id": i, "source": "s", "content": x} for i, x in enumerate(texts)] + [{"id": 9, "source": "s", "content": None}])
    blocks = repeats.block_report(a).collect()
    assert blocks and {b.n_docs for b in blocks} == {4}
    # five of 200 documents are enough of them, but no three percent
    some = [{"id": i, "source": "s", "content": "satu\ndua" if i < 5 else "isi " + "abcdefghij"[i % 10] * (i + 1)} for i in range(200)]
    assert repeats.repeated_lines(articles(spark, some)).count() == 0


# problem 7


def test_near_copies_against_brute_force(spark):
    rnd = random.Random(7)
    vocabulary = [f"kata{i}" for i in range(400)]
    rows, n = [], 0
    for g in range(25):
        base = [rnd.choice(vocabulary) for _ in range(150)]
        for c in range(rnd.choice([1, 2, 4])):
            w = list(base)
            for _ in range(rnd.choice([0, 3, 12, 25])):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            n += 1
            rows.append({"id": n, "title": None if c else "Judul sama", "content": " ".join(w)})
    rows += [{"id": 900, "content": None}, {"id": 901, "content": "pendek"}, {"id": None, "content": " ".join(vocabulary)}]
    got = {(r.article_a, r.article_b) for r in nearcopies.similar_pairs(articles(spark, rows)).collect()}
    sets = {}
    for r in rows:
        w = (r["content"] or "").split()
        if r["id"] and len(w) >= 60:
            w = (r.get("title") or "").lower().split() + w
            sets[r["id"]] = set(zip(w, w[1:], w[2:]))
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.5}
    assert got == want and len(want) > 10
    groups = nearcopies.similar_groups(articles(spark, rows), 0.5, 3).collect()
    assert {r.article_id for r in groups} == {x for p in want for x in p}


def test_versions_of_a_story_that_are_each_copied(spark):
    rnd = random.Random(11)
    vocabulary = [f"kata{i}" for i in range(5000)]
    rows, n = [], 0
    for _ in range(6):
        first = [rnd.choice(vocabulary) for _ in range(160)]
        longer = first + [rnd.choice(vocabulary) for _ in range(100)]
        for base in (first, longer):
            for _ in range(6):
                w = list(base)
                for _ in range(2):
                    w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
                n += 1
                rows.append({"id": n, "content": " ".join(w)})
    rows += [{"id": 500 + i, "content": "sama " * 60 + "beda " * i} for i in range(4)]
    sets = {r["id"]: set(zip(w, w[1:], w[2:])) for r in rows for w in [r["content"].split()]}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.5}
    got = {(r.article_a, r.article_b) for r in nearcopies.similar_pairs(articles(spark, rows)).collect()}
    assert got == want and len(want) > 300


def test_long_lists_and_whole_sets(spark):
    rnd = random.Random(13)
    vocabulary, stock = [f"kata{i}" for i in range(3000)], [f"baku{i}" for i in range(60)]
    rows, n = [], 0
    for _ in range(40):
        base = [rnd.choice(vocabulary) for _ in range(90)]
        for _ in range(2):
            w = stock + base
            for _ in range(rnd.choice([1, 4])):
                w[rnd.randrange(60, len(w))] = rnd.choice(vocabulary)
            n += 1
            rows.append({"id": n, "content": " ".join(w)})
    a = articles(spark, rows)
    made = nearcopies.signatures(a).cache()
    pairs = lambda d: {tuple(r) for r in d.collect()}
    found = pairs(nearcopies.candidates(made, 0.5))
    assert pairs(nearcopies.candidates(made, 0.5, long=20)) == found and len(found) >= 40
    exact = {(r.a, r.b) for r in nearcopies.similar_classes(a, k=None)[1].collect()}
    assert {(r.a, r.b) for r in nearcopies.similar_classes(a)[1].collect()} == exact and len(exact) == 40
    assert nearcopies.similar_pairs(a.where("article_id < 0")).count() == 0


# problem 8


def test_packing(spark):
    sizes = [5000, 4096, 4097, 0, 1, 1, 2000, 2096, 3000, 1000]
    d = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "id bigint, n_tokens bigint")
    p = packing.pack(d, 4096).collect()
    used, total = {}, {}
    for r in p:
        used[r.container] = used.get(r.container, 0) + r.part_tokens
        total[r.id] = total.get(r.id, 0) + r.part_tokens
    assert max(used.values()) <= 4096 and total == dict(enumerate(sizes)) and len(used) == 6
    assert packing.pack(d.where("id < 0"), 4096).count() == 0


def test_first_fit_decreasing_is_that():
    rnd = random.Random(1)
    sizes = [rnd.randrange(0, 100) for _ in range(300)]
    free, want = [], {}
    for i in sorted(range(300), key=lambda k: (-sizes[k], k)):
        b = next((k for k, f in enumerate(free) if f >= sizes[i]), len(free))
        if b == len(free):
            free.append(100)
        free[b] -= sizes[i]
        want[i] = b
    assert packing.first_fit_decreasing(sizes, 100) == [want[i] for i in range(300)]


# problem 9

ITEM = "Andaikan pengurus arisan menimbun lima ratus bibit jati unggul dan mengasuransikan peti jeruk keprok sambil menunggu putusan banding"


def test_leaks(spark):
    w = ITEM.split()
    docs = [
        (1, "Awal. " + ITEM + " akhir."), (2, " ".join(w[2:12])), (3, " ".join(w[2:11]) + " lain"), (4, ITEM.upper().replace(" ", "\xa0")), (5, " ".join(w[:14]).replace("mengasuransikan", "menga-\n> suransikan").replace("jati", "ja­ti")),
        (6, "<p>" + " <b>".join(w[:11]) + "</b>"), (7, None), (8, ""), (9, "xx" + " ".join(w[:10])), (11, " ".join(w[:6]) + f' <a href="/{"x" * 300}">' + " ".join(w[6:11]) + "</a>"), (12, "[" + " ".join(w[:5]) + "](https://a.example/b_(c)) " + " ".join(w[5:11])), (10, " ".join(w[:5] + ["beda"] + w[5:9])),
    ]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = spark.createDataFrame([(1, ITEM), (2, "terlalu pendek"), (3, None), (None, ITEM)], "item_id bigint, text string")
    assert sorted((r.doc_id, r.item_id) for r in leaks.leaked(d, items).collect()) == [(1, 1), (2, 1), (4, 1), (5, 1), (6, 1), (11, 1), (12, 1)]
    assert leaks.leaked(d, items.where("item_id = 99")).count() == 0


def test_alignment_finds_edited_copies(spark):
    w = ITEM.split()
    edited = " ".join(w[:7] + ["sekitar"] + w[7:13] + ["kotak"] + w[14:])
    d = spark.createDataFrame([(1, "Kata mereka, " + edited), (2, " ".join(w[:6]) + " lain sekali dari semua itu"), (3, "tanpa kesamaan sama sekali dengan soal itu")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    found = {r.doc_id: r for r in leaks.find_leaks(d, items).collect()}
    assert set(found) == {1, 2} and found[1].run < 10 and found[1].score >= 2 * 15 > found[2].score


def test_runs_against_brute_force():
    rnd = random.Random(4)
    items = [(i, " ".join(rnd.choice("satu dua tiga empat lima".split()) for _ in range(25))) for i in range(12)]
    index = leaks.ItemIndex(items)
    docs = [(k, " ".join(rnd.choice("satu dua tiga empat lima".split()) for _ in range(15)) + " " + " ".join(dict(items)[k % 12].split()[k % 9 : k % 9 + 6 + k % 8])) for k in range(80)]
    got = {(a, b) for a, b, _, _, run in leaks._leaks_of(docs, index) if run >= 10}
    has = lambda t, x: any(f" {' '.join(x[k : k + 10])} " in f" {t} " for k in range(len(x) - 9))
    assert got == {(k, i) for k, t in docs for i, x in items if has(t, x.split())} and got


def test_alignment_scores():
    def plain(a, b):
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        return max(map(max, h))

    rnd = random.Random(2)
    pairs = [([rnd.randrange(6) for _ in range(rnd.randrange(1, 15))], [rnd.randrange(6) for _ in range(rnd.randrange(1, 20))]) for _ in range(60)]
    assert leaks.align(pairs) == [plain(a, b) for a, b in pairs]


# problem 10


def texts():
    rnd = random.Random(4)
    prose = "\n\n".join(" ".join(rnd.choice(["Kata", "lain", "berikut.", "dan", "12", "ini"]) for _ in range(400)) for _ in range(12))
    return {1: prose, 2: "tanpaspasi" * 3000, 3: "pendek", 4: "a\n" * 5000, 5: " " * 9000 + "x" * 3000, 6: None, 7: ""}


def test_pieces_round_trip(spark):
    t = texts()
    d = spark.createDataFrame(list(t.items()), "id bigint, text string")
    c = counter()
    big = {i for i, x in t.items() if x and c.count(x) > 1500}
    assert set(ids(splitting.oversized(d, 1500).select("id"))) == big
    by = {}
    for r in splitting.split_texts(d, 1500, 100).collect():
        by.setdefault(r.id, []).append(r)
    assert set(by) == big
    for i, own in by.items():
        own.sort(key=lambda r: r.piece_no)
        assert "".join(t[i][r.own_start : r.end] for r in own) == t[i]
        assert all(t[i][r.start : r.end] == r.piece and c.count(r.piece) <= 1500 for r in own)
        assert all(r.start < r.own_start for r in own[1:])


def test_ranges_agree(monkeypatch):
    c = counter()
    for x in (texts()[1], texts()[2]):
        whole = splitting._scan(0, 0, 0, 0, len(x), x, c.count)[1]
        total = 0
        for s in range(0, len(x), 3000):
            lead = min(s, splitting.HALO)
            total += splitting._scan(0, 0, s, lead, min(3000, len(x) - s), x[s - lead : s + 3000 + splitting.HALO], c.count)[1]
        assert total == whole


def test_files_by_ranges(spark, tmp_path):
    p = tmp_path / "big.txt"
    p.write_text(texts()[1] * 3 + " é à " * 200, encoding="utf-8")
    raw = p.read_bytes()
    own = sorted(splitting.split_files(spark, [str(p)], 1500, 100, range_bytes=20_000).collect(), key=lambda r: r.piece_no)
    assert b"".join(raw[r.own_start : r.end] for r in own) == raw and max(r.n_tokens for r in own) <= 1500


def spaceless():
    rnd = random.Random(8)
    return {k: "".join(chr(rnd.randrange(a, b)) for _ in range(12_000)) for k, (a, b) in enumerate([(0x1B83, 0x1BA0), (0xA984, 0xA9B2), (0x4E00, 0x9FA0), (0x1F600, 0x1F640)])}


@pytest.mark.parametrize("limit,overlap", [(1500, 100), (300, 50)])
def test_pieces_of_scripts_without_spaces(spark, limit, overlap):
    t, c = spaceless(), counter()
    by = {}
    for r in splitting.split_texts(spark.createDataFrame(list(t.items()), "id bigint, text string"), limit, overlap).collect():
        by.setdefault(r.id, []).append(r)
    assert set(by) == set(t)
    for i, own in by.items():
        own.sort(key=lambda r: r.piece_no)
        assert [r.piece_no for r in own] == list(range(len(own)))
        assert "".join(t[i][r.own_start : r.end] for r in own) == t[i]
        assert max(c.count(r.piece) for r in own) <= limit
        assert all(c.count(t[i][r.start : r.own_start]) >= overlap - 4 for r in own[1:])


def test_files_without_spaces(spark, tmp_path):
    p = tmp_path / "spaceless.txt"
    p.write_text("".join(spaceless().values()), encoding="utf-8")
    raw = p.read_bytes()
    own = sorted(splitting.split_files(spark, [str(p)], 1500, 100, range_bytes=20_000).collect(), key=lambda r: r.piece_no)
    assert b"".join(raw[r.own_start : r.end] for r in own) == raw and max(r.n_tokens for r in own) <= 1500
    assert not any("\ufffd" in r.piece for r in own)


def test_every_query_runs_on_the_smallest_tables(spark):
    from lexaudit.llm.queries import QUERIES

    for name in ("p4_found", "p3_found", "p9_found", "p8_fill"):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").select(F.count("*")).collect()
