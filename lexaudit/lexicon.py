"""Word lists and their use: one set of patterns is one alternation, or one sum of tests behind it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the lexicon sets, in their own order.
SETS: dict[str, list[str]] = {
    "labour_anchors": [
        r"\bkota[\s\-]?bandung", r"\bpemkot[\s\-]?bandung", r"\bwali[\s\-]?kota[\s\-]?bandung", r"\bbandung[\s\-]?kota",
        r"\bdprd[\s\-]?kota[\s\-]?bandung", r"\bdisnaker[\s\-]?kota[\s\-]?bandung", r"\bdisnaker[\s\-]?bandung", r"\bpemkot[\s\-]?bdg",
        r"\bkotamadya[\s\-]?bandung",
    ],
    "labour_districts": [
        r"\bandir", r"\bastana[\s\-]?anyar", r"\bantapani", r"\barcamanik", r"\bbabakan[\s\-]?ciparay", r"\bbandung[\s\-]?kidul",
        r"\bbandung[\s\-]?kulon", r"\bbandung[\s\-]?wetan", r"\bbatununggal", r"\bbojongloa[\s\-]?kaler", r"\bbojongloa[\s\-]?kidul",
        r"\bbuah[\s\-]?batu", r"\bcibeunying", r"\bcibiru", r"\bcicendo", r"\bcidadap", r"\bcinambo", r"\bcoblong", r"\bgede[\s\-]?bage",
        r"\bkiara[\s\-]?condong", r"\blengkong", r"\bmandalajati", r"\bpanyileukan", r"\branca[\s\-]?sari", r"\bregol", r"\bsukajadi", r"\bsukasari",
        r"\bsumur[\s\-]?bandung", r"\bujung[\s\-]?berung",
    ],
    "labour_landmarks": [
        r"\bjl\.?\s?asia\s?afrika", r"\bjl\.?\s?dago", r"\bjl\.?\s?braga", r"\balun[\s\-]?alun", r"\bgedung\s?sate", r"\btrans\s?studio", r"\bgasibu",
    ],
    "labour_elsewhere": [
        r"\bkabupaten[\s\-]?bandung", r"\bkab\.?\s?bandung", r"\bsoreang", r"\bkbb", r"\bbandung[\s\-]?barat", r"\blembang", r"\bcimahi",
    ],
    "labour_positive": [
        r"\bbuka lowongan", r"\blowongan[\s\-]?kerja", r"\blowongan[\s\-]?pabrik", r"\brekrutmen", r"\brekrutmen[\s\-]?massal",
        r"\brekrutmen[\s\-]?terbuka", r"\bpenerimaan[\s\-]?karyawan", r"\bpenerimaan[\s\-]?pegawai", r"\bpenerimaan[\s\-]?tenaga[\s\-]?kerja",
        r"\bterima[\s\-]?karyawan", r"\bjob[\s\-]?fair", r"\bbursa[\s\-]?kerja", r"\bbursa[\s\-]?kerja khusus", r"\bbkk", r"\bexpo[\s\-]?kerja",
        r"\bpameran[\s\-]?kerja", r"\bhiring", r"\bwe are hiring", r"\bdibutuhkan segera", r"\bbutuh tenaga", r"\bmembuka posisi", r"\bkarir terbuka",
        r"\bcareer opportunity", r"\bpadat karya", r"\bserap tenaga kerja", r"\bpenyerapan tenaga kerja", r"\bmembuka lapangan kerja",
        r"\btambah karyawan", r"\bpenambahan pekerja", r"\bpenambahan sdm", r"\bpenambahan tenaga", r"\bpabrik baru", r"\bbuka pabrik",
        r"\bpabrik ekspansi", r"\bpeningkatan produksi", r"\bpeningkatan kapasitas", r"\bekspansi bisnis", r"\bproyek infrastruktur",
        r"\binvestasi baru", r"\binvestasi pabrik", r"\bpelatihan kerja", r"\bmagang", r"\bpraktek kerja", r"\bapprentice", r"\bvokasi",
    ],
    "labour_negative": [
        r"\bphk", r"\bpemutusan hubungan kerja", r"\bdirumahkan", r"\bpemecatan", r"\bdipecat", r"\brasionalisasi karyawan",
        r"\brasionalisasi tenaga kerja", r"\brasionalisasi\s+sdm", r"\bright[\s\-]?sizing", r"\bdown[\s\-]?sizing", r"\brestrukturisasi organisasi",
        r"\brefisiensi\s?sdm", r"\befisiensi\s?sumber\s?daya\s?manusia", r"\bpengurangan tenaga kerja", r"\bpengurangan karyawan",
        r"\bpenyesuaian struktur", r"\boptimalisasi tenaga kerja", r"\bpemangkasan\s+pegawai", r"\bpemangkasan\s+karyawan",
        r"\breduksi\s+tenaga\s+kerja", r"\breduksi\s+sdm", r"\btidak diperpanjang kontrak", r"\bkontrak tidak dilanjutkan", r"\bkontrak habis",
        r"\bkontrak berakhir", r"\bberhenti beroperasi", r"\bpenutupan operasional", r"\bpenghentian produksi", r"\bpenghentian operasi",
        r"\bsuspend\s?operasi", r"\btutup sementara", r"\bpabrik tutup", r"\btutup pabrik", r"\bgulung tikar", r"\bbangkrut", r"\bpailit",
        r"\blikuidasi", r"\bpenutupan perusahaan", r"\bpenutupan pabrik", r"\bkurangi karyawan", r"\bkurangi tenaga", r"\bpemotongan\s?pegawai",
        r"\bpengurangan\s?shift", r"\bpemotongan\s?jam\s?kerja", r"\bpengurangan\s?jam\s?kerja", r"\bgagal panen", r"\bpuso",
        r"\bomzet turun drastis", r"\bsepi pembeli", r"\bsepi order", r"\bkehilangan kontrak", r"\brelokasi pabrik", r"\bpindah pabrik",
    ],
    "labour_issue": [
        r"\bupah minimum", r"\bump", r"\bumk", r"\bumr", r"\bumkm", r"\bgaji", r"\bpeningkatan upah", r"\bkenaikan upah", r"\bupah buruh",
        r"\bupah pekerja", r"\btunjangan", r"\bthr", r"\btunjangan hari raya", r"\bbpjs ketenagakerjaan", r"\bjamsostek", r"\bpesangon",
        r"\buang pesangon", r"\bbonus karyawan", r"\bdemo buruh", r"\bunjuk rasa buruh", r"\bpemogokan", r"\baksi mogok", r"\bmogok kerja",
        r"\bserikat pekerja", r"\bserikat buruh", r"\bout[\s\-]?sourcing", r"\bpekerja kontrak", r"\bpkwt", r"\bpkwtt", r"\bkontrak kerja",
        r"\bperjanjian kerja", r"\bhak pekerja", r"\bkesejahteraan buruh", r"\bcuti bersama", r"\blembur", r"\bk3", r"\bkeselamatan kerja",
    ],
    "labour_noise": [
        r"\bpersib", r"\bliga", r"\bpilkada", r"\bcpns", r"\bsyarat pendaftaran", r"\bgempa", r"\bkecelakaan", r"\bpembunuhan", r"\bnarkoba",
        r"\bbencana", r"\bpilkada", r"\bkampanye", r"\bcapres", r"\bcawalkot", r"\bpartai", r"\bkpu", r"\bbawaslu", r"\bkampus", r"\buniversitas",
        r"\binstitut", r"\bpoliteknik", r"\bmahasiswa", r"\bdosen", r"\brektor", r"\bwisuda", r"\bsnbt", r"\bppdb", r"\bseminar", r"\bwebinar",
        r"\basn", r"\bcpns", r"\bpppk", r"\bmutasi jabatan", r"\brotasi jabatan", r"\bkinerja asn", r"\bsyarat pendaftaran", r"\bcara melamar",
        r"\blink pendaftaran", r"\bkirim lamaran",
    ],
    "labour_title_stop": [
        r"\bvisi", r"\bmisi", r"\btupoksi", r"\bkontak", r"\bjadwal", r"\bindeks", r"\bpegawai", r"\bsejarah", r"\bgallery", r"\bprofil", r"\bbab i",
        r"\bpower[\s\-]?point", r"\bopen[\s\-]?data", r"\bjurnal", r"\bpengumuman", r"\blayanan", r"\bberanda", r"\bhome", r"\bindex",
    ],
    "topic_primary": [
        r"\bketenaga[\s\-]?kerjaan", r"\btenaga[\s\-]?kerja", r"\bpengangguran", r"\blowongan[\s\-]?kerja", r"\bPHK",
        r"\bpemutusan[\s\-]?hubungan[\s\-]?kerja", r"\bupah[\s\-]?minimum", r"\bUMK", r"\bUMP", r"\bUMR", r"\bburuh", r"\bserikat[\s\-]?pekerja",
        r"\bBPJS[\s\-]?Ketenagakerjaan", r"\bDisnaker", r"\bDinas[\s\-]?Tenaga[\s\-]?Kerja", r"\bTPK", r"\bTingkat[\s\-]?Pengangguran[\s\-]?Terbuka",
        r"\bTPAK", r"\bpadat[\s\-]?karya", r"\bout[\s\-]?sourcing", r"\bkontrak[\s\-]?kerja", r"\bmagang", r"\bpelatihan[\s\-]?kerja",
        r"\bangkatan[\s\-]?kerja", r"\binformal", r"\bBLK", r"\bBalai[\s\-]?Latihan[\s\-]?Kerja",
    ],
    "topic_secondary": [
        r"\bUMKM", r"\binvestasi", r"\bindustri", r"\bekonomi", r"\binflasi", r"\bmanufaktur", r"\bperdagangan", r"\bpariwisata", r"\bdigitalisasi",
        r"\bautomasi", r"\bgig[\s\-]?economy", r"\bBPS", r"\bBadan[\s\-]?Pusat[\s\-]?Statistik", r"\bsertifikasi", r"\bpelatihan", r"\bproduktivitas",
    ],
    "place_primary": [
        r"\bBandung\b", r"\bKota[\s\-]?Bandung\b",
    ],
    "place_secondary": [
        r"\bJawa[\s\-]?Barat\b", r"\bJabar\b", r"\bMetropolitan[\s\-]?Bandung\b", r"\bBandung[\s\-]?Raya\b",
    ],
    "off_topic": [
        r"gosip|selebriti|artis", r"sepak\s*bola|liga\s*bola|pertandingan", r"resep\s*masakan", r"zodiak|ramalan|horoscope",
        r"drama\s*korea|drakor|K-pop",
    ],
    "trade_anchors": [
        r"\bkota[\s\-]?bandung\b", r"\bpemkot[\s\-]?bandung\b", r"\bwali[\s\-]?kota[\s\-]?bandung\b", r"\bbandung[\s\-]?kota\b",
        r"\bdprd[\s\-]?kota[\s\-]?bandung\b", r"\bdisdagin[\s\-]?kota[\s\-]?bandung\b", r"\bdkpp[\s\-]?kota[\s\-]?bandung\b",
    ],
    "trade_international": [
        r"\bekspor\b", r"\bimpor\b", r"\bpasar[\s\-]?global\b", r"\bpasar[\s\-]?internasional\b", r"\bmancanegara\b", r"\bluar[\s\-]?negeri\b",
        r"\bbea[\s\-]?cukai\b", r"\bkite[\s\-]?ikm\b",
    ],
    "trade_domestic": [
        r"\bpasokan\b", r"\bsuplai\b", r"\brantai[\s\-]?pasok\b", r"\blogistik\b", r"\bdistribusi\b", r"\bantar[\s\-]?daerah\b",
        r"\bantar[\s\-]?provinsi\b", r"\bkontainer\b", r"\bdry[\s\-]?port\b",
    ],
    "trade_indicators": [
        r"\bkelangkaan\b", r"\bkenaikan[\s\-]?harga\b", r"\bstok\b", r"\bfluktuasi\b", r"\bharga[\s\-]?eceran\b", r"\bhet\b", r"\binflasi\b",
        r"\bdefisit\b", r"\bsurplus\b",
    ],
    "trade_commodities": [
        r"\bberas\b", r"\bjagung\b", r"\bminyak[\s\-]?goreng\b", r"\bgula\b", r"\bterigu\b", r"\bkedelai\b", r"\bcabai\b", r"\bbawang\b",
        r"\bsayur\b", r"\bdaging\b", r"\btelur\b", r"\bpakaian\b", r"\bgarmen\b", r"\bsepatu\b", r"\btekstil\b", r"\bsemen\b", r"\belpiji\b",
        r"\bbbm\b", r"\bkopi\b", r"\bkakao\b", r"\bkosmetik\b",
    ],
}
# Flags of social posts, in the order in which they are listed.
FLAGS: dict[str, list[str]] = {
    "realisasi_pengeluaran_sosial": [
        r"\btersalurkan\b", r"\brealisasi\b", r"\bdistribusi\b", r"\bpenyaluran\b", r"\bpenyerahan[- ]?sumbangan\b", r"\bmenyerahkan[- ]?bantuan\b",
        r"\bpaket[- ]?makanan\b", r"\bpangan[- ]?yatim\b", r"\bbantuan[- ]?operasional\b", r"\bsumbangan[- ]?dana\b",
    ],
    "kampanye_fundraising": [
        r"\byuk[- ]?donasi\b", r"\bscan[- ]?qris\b", r"\bsalurkan[- ]?donasi\b", r"\btransfer[- ]?ke\b", r"\bopen[- ]?donasi\b",
        r"\brekening[- ]?donasi\b", r"\btunaikan[- ]?zakat\b", r"\bbayar[- ]?zakat\b", r"\bsedekah\b", r"\binfaq\b", r"\bgalang[- ]?dana\b",
        r"\bklik[- ]?link\b",
    ],
    "advokasi_dan_pekerja": [
        r"\bpetisi\b", r"\bsikap\b", r"\bregulasi\b", r"\btolak\b", r"\bserikat[- ]?pekerja\b", r"\brealita[- ]?miris\b", r"\beksploitasi\b",
        r"\bdimanipulasi\b", r"\bkesejahteraan\b", r"\bnasib[- ]?para\b", r"\bkebutuhan[- ]?hidup[- ]?layak\b", r"\baudiensi\b", r"\btuntutan\b",
    ],
    "konsolidasi_dan_politik": [
        r"\bverifikasi[- ]?faktual\b", r"\bkpu\b", r"\bbawaslu\b", r"\bsilaturahmi\b", r"\bpenyerahan[- ]?sk\b", r"\bpelantikan[- ]?pengurus\b",
        r"\bpimda\b", r"\bdpc\b", r"\brakercab\b", r"\bkonsolidasi\b", r"\bsambangi\b", r"\bwali[- ]?kota\b",
    ],
    "edukasi_religi_dan_hari_besar": [
        r"\bhukum[- ]?zakat\b", r"\bkeutamaan\b", r"\bpahala\b", r"\bdalil\b", r"\bmarhaban[- ]?ya[- ]?ramadan\b", r"\bibadah[- ]?puasa\b",
        r"\bidul[- ]?fitri\b", r"\bhewan[- ]?qurban\b", r"\bpenyembelihan\b", r"\bhikmah\b", r"\bberkah\b", r"\bsyariat\b",
    ],
    "simpati_dan_duka_cita": [
        r"\bturut[- ]?berduka[- ]?cita\b", r"\bberpulangnya[- ]?ke[- ]?rahmatullah\b", r"\bwafatnya\b", r"\bamal[- ]?ibadahnya[- ]?diterima\b",
        r"\bkeluarga[- ]?yang[- ]?ditinggalkan\b", r"\bketabahan\b", r"\bhusnul[- ]?kh[oa]timah\b",
    ],
    "kegiatan_reuni_dan_event": [
        r"\breuni[- ]?akbar\b", r"\btemu[- ]?kangen\b", r"\bhalal[- ]?bihalal\b", r"\bmubes\b", r"\bmusyawarah[- ]?besar\b", r"\btiket[- ]?masuk\b",
        r"\bkongres\b", r"\bgathering[- ]?alumni\b", r"\bjalan[- ]?sehat\b", r"\bturnamen[- ]?golf\b", r"\bcharity[- ]?golf\b",
    ],
    "program_beasiswa_dan_pendidikan": [
        r"\bpenyaluran[- ]?beasiswa\b", r"\bdana[- ]?abadi\b", r"\bdonasi[- ]?beasiswa\b", r"\bbantuan[- ]?ukt\b", r"\bmahasiswa[- ]?berprestasi\b",
        r"\bawardee\b", r"\bpembayaran[- ]?ukt\b", r"\bpeduli[- ]?pendidikan\b",
    ],
    "penjualan_merchandise": [
        r"\bpre[- ]?order\b", r"\bopen[- ]?po\b", r"\bmerchandise[- ]?resmi\b", r"\bkaos[- ]?alumni\b", r"\bjaket[- ]?alumni\b", r"\bsouvenir\b",
        r"\bharga[- ]?spesial\b",
    ],
}
# Domains by credibility.
CREDIBILITY: dict[str, list[str]] = {
    "high": [
        "bandung.go.id", "tempo.co", "tirto.id", "narasi.tv", "ayobandung.com", "pikiran-rakyat.com", "bandung.kompas.com",
        "disdagin.bandung.go.id", "cnnindonesia.com", "rri.co.id", "jabarprov.go.id", "bps.go.id", "kemnaker.go.id", "kompas.com",
        "detik.com",
    ],
    "medium": [
        "radarbandung.id", "kumparan.com", "infobandungkota.com", "prfmnews.id", "kilasbandungnews.com", "bandungbergerak.id",
        "koranmandala.com", "jabarekspres.com", "jabar.tribunnews.com", "liputan6.com", "merdeka.com", "sindonews.com",
    ],
    "low": [
        "blogspot.com", "wordpress.com", "medium.com", "facebook.com", "twitter.com", "instagram.com",
    ],
}
# File name endings of documents that are no pages, and words of titles of pages that are no news.
EXTENSIONS = [".pdf", ".doc", ".docx", ".xls", ".xlsx"]
TRADE_EXTENSIONS = [".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx"]
TRADE_TITLE_STOP = [
        "pegawai", "sejarah", "visi", "misi", "tupoksi", "kontak", "gallery", "profil", "rencana strategis", "bab i", "powerpoint",
        "open data", "loker", "jurnal", "pengumuman", "layanan", "jadwal", "detail", "slidefabric", "kode pos", "beranda", "home",
        "indeks", "index", "kategori", "registrasi imei",
]
CREDIBLE_DOMAINS = ["kompas.com", "tempo.co", "tirto.id", "detik.com", "liputan6.com", "bandung.go.id", "jabarprov.go.id", "disnaker.bandung.go.id"]


def let(value: Column, body) -> Column:
    """body(value) with the value made once, however often the body names it, and out of generated code, whose limit
    hundreds of tests would outgrow."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def add_set(name: str, patterns: list[str]) -> None:
    """Registers a set of one's own; patterns are regular expressions for lower-cased text."""
    import re

    for p in patterns:
        re.compile(p)  # a faulty pattern is reported here, not in a task
    SETS[name] = list(patterns)


def patterns(name: str, mode: str = "regex", whole_words: bool = False) -> list[str]:
    """The patterns of a set, distinct. mode "literal" takes them as plain text; whole_words ends each at a word's end."""
    found = list(dict.fromkeys(SETS[name]))
    if mode == "literal":
        import re

        return [re.escape(p) for p in found]
    return [p if not whole_words or p.endswith(r"\b") else p + r"\b" for p in map(str.lower, found)]


def alternation(*names: str, mode: str = "regex", whole_words: bool = False) -> str:
    """One pattern that matches where any pattern of the sets does."""
    every = [p for n in names for p in patterns(n, mode, whole_words)]
    if all(p.startswith(r"\b") for p in every):  # tested once a place, not once a pattern
        return r"\b(?:" + "|".join(p[2:] for p in every) + ")"
    return "(?:" + "|".join(every) + ")"


def any_of(text: Column, *names: str, mode: str = "regex", whole_words: bool = False) -> Column:
    """Whether any pattern of the sets matches: one alternation. NULL text gives NULL."""
    return text.rlike(alternation(*names, mode=mode, whole_words=whole_words))


def _tests(t: Column, names: tuple[str, ...], mode: str, whole_words: bool) -> Column:
    """An array of whether each pattern of the sets matches: its stem is looked for first. The patterns are constants, so
    that each is compiled once a task."""
    return F.array(*[t.contains(stem(p)) & t.rlike(p) if stem(p) else t.rlike(p) for n in names for p in patterns(n, mode, whole_words)])


def hit_count(text: Column, *names: str, mode: str = "regex", whole_words: bool = False) -> Column:
    """How many patterns match, each counted once. NULL counts 0.

    A regular expression is tried only where the text holds its stem.
    """
    return let(text, lambda t: F.size(F.filter(_tests(t, names, mode, whole_words), lambda x: x)))


def stem(pattern: str) -> str:
    """The longest text that every match of a pattern holds; empty where there is none to be told."""
    import re

    if "|" in pattern or "(" in pattern:
        return ""
    gap = "\n"  # stands for anything
    s = re.sub(r"\[[^\]]*\]|\\[bsdw]", gap, pattern)
    s = re.sub(r"\\.", gap, s)
    s = re.sub(r"[^\n][?*]", gap, s)
    return max(re.split(r"[\n?*+.^$]", s), key=len)


def hits(text: Column, name: str) -> Column:
    """The patterns of a set that match, as an array in the set's order; empty for NULL."""
    found = patterns(name)
    names = F.array(*[F.lit(p) for p in found])
    pairs = lambda t: F.arrays_zip(_tests(t, (name,), "regex", False).alias("hit"), names.alias("pattern"))
    return let(text, lambda t: F.transform(F.filter(pairs(t), lambda x: x["hit"]), lambda x: x["pattern"]))


# the same tests as SQL, for the queries' SQL


def sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def sql_any(text: str, *names: str, mode: str = "regex", whole_words: bool = False) -> str:
    return f"regexp_matches({text}, {sql_text(alternation(*names, mode=mode, whole_words=whole_words))})"


def sql_count(text: str, *names: str, mode: str = "regex", whole_words: bool = False) -> str:
    tests = [f"CAST(regexp_matches({text}, {sql_text(p)}) AS INTEGER)" for n in names for p in patterns(n, mode, whole_words)]
    return f"COALESCE({' + '.join(tests)}, 0)"
