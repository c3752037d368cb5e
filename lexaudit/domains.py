"""Word lists of the three standalone jobs (labour, trade, non-profit), and the rules over them, as columns and as SQL."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexaudit import lexicon
from lexaudit.lexicon import SETS


def whole_words(*lists: str) -> list[str]:
    """A pattern for each entry of comma-separated lists: the words as they stand, from word boundary to word boundary."""
    return [rf"\b{w.strip()}\b" for x in lists for w in x.split(",")]


# Places outside the city, of the labour job.
LABOUR_ELSEWHERE = [
    r"\bkabupaten[\s\-]?bandung\b", r"\bkab\.?\s?bandung\b", r"\bbupati\s+bandung\b", r"\bsoreang\b", r"\bkbb\b", r"\bbandung[\s\-]?barat\b",
    *whole_words(
        "lembang, cimahi, majalaya, pangalengan, ciwidey, padalarang, pemkab",
        "bekasi, bogor, depok, karawang, purwakarta, sukabumi, ciamis, tasikmalaya, garut, cirebon, cianjur, indramayu",
        "jakarta, dki jakarta, jawa tengah, jateng, semarang, jawa timur, jatim, surabaya",
    ),
]
# Words of other matters, of the labour job.
LABOUR_NOISE = whole_words(
    "piala, liga, persib, maung, transfer pemain, rekrut pemain", "gempa, kecelakaan, pembunuhan, narkoba, bencana",
    "pilkada, kampanye, capres, cawalkot, partai, kpu, bawaslu",
    "kampus, universitas, institut, politeknik, mahasiswa, dosen, rektor, wisuda, snbt, ppdb, seminar, webinar",
    "asn, cpns, pppk, mutasi jabatan, rotasi jabatan, kinerja asn", "syarat pendaftaran, cara melamar, link pendaftaran, kirim lamaran",
)
# Words of titles of pages that are no news, of the labour job.
LABOUR_TITLE_STOP = "pegawai, sejarah, visi, misi, tupoksi, kontak, gallery, profil, bab i, powerpoint, open data, jurnal, pengumuman, layanan, jadwal, beranda, home, indeks, index".split(", ")
# Anchors of the non-profit job; the trade job has its own.
NONPROFIT_ANCHORS = [
    r"\bkota[\s\-]?bandung\b", r"\bpemkot[\s\-]?bandung\b", r"\bwali[\s\-]?kota[\s\-]?bandung\b", r"\bbandung[\s\-]?kota\b", r"\bdprd[\s\-]?kota[\s\-]?bandung\b",
    r"\bdinsos[\s\-]?kota[\s\-]?bandung\b", r"\bkesbangpol[\s\-]?kota[\s\-]?bandung\b",
]
# Districts and quarters, of the trade and the non-profit job.
QUARTERS = [
    r"\bandir\b", r"\bastana[\s\-]?anyar\b", r"\bantapani\b", r"\barcamanik\b", r"\bbabakan[\s\-]?ciparay\b", r"\bbandung[\s\-]?kidul\b", r"\bbandung[\s\-]?kulon\b",
    r"\bbandung[\s\-]?wetan\b", r"\bbatununggal\b", r"\bbojongloa[\s\-]?kaler\b", r"\bbojongloa[\s\-]?kidul\b", r"\bbuah[\s\-]?batu\b", r"\bcibeunying\b", r"\bcibiru\b",
    r"\bcicendo\b", r"\bcidadap\b", r"\bcinambo\b", r"\bcoblong\b", r"\bgedebage\b", r"\bkiara[\s\-]?condong\b", r"\blengkong\b", r"\bmandalajati\b", r"\bpanyileukan\b",
    r"\brancasari\b", r"\bregol\b", r"\bsukajadi\b", r"\bsukasari\b", r"\bsumur[\s\-]?bandung\b", r"\bujung[\s\-]?berung\b", r"\bcibaduyut\b", r"\bpasar[\s\-]?baru\b",
    r"\bsuci\b", r"\bcigondewah\b", r"\bbinong\b",
]
# Places outside the city, of the trade and the non-profit job.
PLACES_ELSEWHERE = [
    r"\bkabupaten[\s\-]?bandung\b", r"\bbupati\b", r"\bsoreang\b", r"\bkbb\b", r"\bbandung[\s\-]?barat\b",
    *whole_words(
        "lembang, cimahi, majalaya, pangalengan, ciwidey, padalarang, pemkab", "bekasi, bogor, depok, karawang, purwakarta",
        "sukabumi, ciamis, tasikmalaya, garut, cirebon", "cianjur, indramayu, majalengka, sumedang, subang, kuningan",
        "jakarta, dki jakarta, jawa tengah, jateng, semarang", "jawa timur, jatim, surabaya, malang, banten, tangerang",
        "yogyakarta, diy, jogja, bali, denpasar", "sumatera, sumut, medan, sumbar, padang, sumsel, palembang",
        "riau, batam, lampung, bengkulu, jambi, aceh", "kalimantan, kalbar, pontianak, kaltim, balikpapan, samarinda",
        "kalsel, banjarmasin, kalteng, palangkaraya", "sulawesi, sulsel, makassar, sulut, manado, sulteng, palu",
        "papua, maluku, ambon, ntb, mataram, ntt, kupang",
    ),
]
# Words of other matters, of the trade job.
TRADE_NOISE = [
    *whole_words("piala, liga, gempa, kecelakaan, pembunuhan, persib", "skandal, pilkada, kampanye, capres, cawalkot, partai", "hakim, peradilan, narkoba, tiket, konser"),
    r"\bsurat[\s\-]?suara\b",
    *whole_words(
        "wisatawan, kuliner, bpbd, bencana, cuaca ekstrem", "pohon tumbang, hujan deras, kpu, bawaslu, logistik pemilu", "bunuh diri, pengeroyokan",
        "cpns, lowongan, loker, rekrutmen", "kampus, universitas, institut, politeknik, akademi, sekolah tinggi",
        "uin, itb, unpas, unpad, upi, telkom university, unpar, unisba", "mahasiswa, dosen, guru besar, rektor, dekan",
        "wisuda, dies natalis, snbt, ppdb, kemendikdasmen", "seminar, webinar, simposium, lokakarya, konferensi",
        "sidang terbuka, skripsi, tesis, disertasi, sman, smpn", "pramuka, jambore",
        "mobil dinas, kendaraan dinas, aparatur sipil negara, asn, wfh", "apel pagi, mutasi jabatan, rotasi jabatan, disiplin pegawai, kinerja asn",
    ),
]
# What non-profit bodies do, what they are called, and words of other matters.
ACTIVITIES = whole_words(
    "memberikan bantuan, menyalurkan sumbangan, bakti sosial, baksos, donasi", "sedekah, khitanan massal, donor darah, pembagian sembako, berbagi takjil",
    "menyalurkan zakat, infaq, pembagian daging kurban, qurban, hewan kurban", "santunan, tali asih, beasiswa, penggalangan dana, fundraising, galang dana",
    "musyawarah cabang, muscab, musda, muktammar, deklarasi, reuni akbar", "pelantikan pengurus, kampanye, konsolidasi, milad, harlah, jalan sehat",
    "gerak jalan, sepeda gembira, tabligh akbar, pengajian, rapat kerja, raker", "rapat pimpinan, rapim, buka bersama, bukber, halal bihalal, halalbihalal",
    "silaturahmi, dies natalis",
)
BODIES = whole_words(
    "yayasan, baznas, lazis, dt peduli, rumah zakat, dompet dhuafa", "panti asuhan, masjid raya, gereja, panti jompo, pesantren, pondok pesantren",
    "ponpes, majelis taklim, nu, nahdlatul ulama, muhammadiyah, persis", "ikatan alumni, ika unpad, ika itb, pgri, idi, pwi, serikat pekerja",
    "partai buruh, lsm, karang taruna, pkk, komunitas, paguyuban, fkppi", "ikatan dokter, knpi, pramuka, jambore",
    "partai politik, dpc, dpd, dpw, pdi perjuangan, golkar, gerindra", "pks, demokrat, nasdem, pan, pkb, psi, gelora, hanura", "perindo, partai umat",
    "ormas, pemuda pancasila, manggala, gibad, ams, brigez",
)
NONPROFIT_NOISE = whole_words(
    "piala, liga, gempa, kecelakaan, pembunuhan, persib", "skandal, hakim, peradilan, narkoba, tiket, konser", "wisatawan, kuliner, bpbd, cuaca ekstrem",
    "pohon tumbang, hujan deras, bunuh diri, pengeroyokan", "cpns, lowongan, loker, rekrutmen, sman, smpn, sdn",
    "kampus, universitas, institut, politeknik, akademi, sekolah tinggi", "uin, itb, unpas, unpad, upi, telkom university, unpar, unisba",
    "mahasiswa, dosen, guru besar, rektor, dekan", "wisuda, snbt, ppdb, kemendikdasmen", "skripsi, tesis, disertasi",
    "mobil dinas, kendaraan dinas, aparatur sipil negara, asn, wfh", "apel pagi, mutasi jabatan, rotasi jabatan, disiplin pegawai, kinerja asn",
    "bansos kemensos, apbd, apbn, dana desa, blt", "bantuan langsung tunai, pkh, program keluarga harapan, csr",
)


def _plain(patterns: list[str]) -> list[str]:
    """Patterns with plain spaces between words, from word boundary to word boundary."""
    return [p.replace(r"[\s\-]?", " ") + r"\b" for p in patterns]


def _closed(patterns: list[str]) -> list[str]:
    return [p if p.endswith(r"\b") else p + r"\b" for p in patterns]


# the standalone labour job writes most of the modular sets' words, but as whole words and with plain spaces
SETS |= {
    "work_anchors": _closed(SETS["labour_anchors"]), "work_districts": [p for p in QUARTERS[:29]], "work_landmarks": _closed(SETS["labour_landmarks"]),
    "work_elsewhere": LABOUR_ELSEWHERE, "work_noise": LABOUR_NOISE, "work_positive": _plain(SETS["labour_positive"]), "work_negative": _closed(SETS["labour_negative"]),
    "work_issue": [r"\boutsourcing\b" if "sourcing" in p else p for p in _closed(SETS["labour_issue"])],
    "trade_districts": QUARTERS, "trade_elsewhere": PLACES_ELSEWHERE, "trade_noise": TRADE_NOISE,
    "nonprofit_anchors": NONPROFIT_ANCHORS, "nonprofit_activities": ACTIVITIES, "nonprofit_bodies": BODIES, "nonprofit_noise": NONPROFIT_NOISE,
}


@dataclass(frozen=True)
class Domain:
    """The sets a job's rules use; topic is one side of the signal, or both sides of two sets of which each must be found."""

    anchors: str
    noise: str
    topic: tuple[tuple[tuple[str, ...], ...], ...]  # any of these: all of these: any of these sets


TRADE = Domain("trade_anchors", "trade_noise", ((("trade_international",),), (("trade_domestic", "trade_indicators"), ("trade_commodities",))))
NONPROFIT = Domain("nonprofit_anchors", "nonprofit_noise", ((("nonprofit_activities", "nonprofit_bodies"),),))


class Columns:
    """Tests as columns."""

    def any(self, text, *sets: str):
        return lexicon.any_of(text, *sets)

    def words(self, text, words: list[str]):
        return text.rlike("(?:" + "|".join(map(re.escape, words)) + ")")

    def endings(self, url, endings: list[str]):
        return url.rlike("(?:" + "|".join(map(re.escape, endings)) + r")(?:$|\?)")

    both = staticmethod(lambda a, b: a & b)
    either = staticmethod(lambda a, b: a | b)
    no = staticmethod(lambda a: ~a)

    def first(self, rules, none: str) -> Column:
        from lexaudit.operators.rules import first_reason

        return first_reason(rules, none)


class Sql(Columns):
    """The same tests as SQL text."""

    def any(self, text, *sets: str):
        return lexicon.sql_any(text, *sets)

    def words(self, text, words: list[str]):
        return "(" + " OR ".join(f"contains({text}, {lexicon.sql_text(w)})" for w in words) + ")"

    def endings(self, url, endings: list[str]):
        return "(" + " OR ".join(f"ends_with({url}, '{e}') OR contains({url}, '{e}?')" for e in endings) + ")"

    both = staticmethod(lambda a, b: f"({a} AND {b})")
    either = staticmethod(lambda a, b: f"({a} OR {b})")
    no = staticmethod(lambda a: f"(NOT {a})")

    def first(self, rules, none: str) -> str:
        return "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r in rules) + f" ELSE '{none}' END"


def signal(domain: Domain, text, t: Columns):
    """Whether a text shows a job's topic."""
    out = None
    for alternative in domain.topic:
        every = None
        for sets in alternative:
            every = t.any(text, *sets) if every is None else t.both(every, t.any(text, *sets))
        out = every if out is None else t.either(out, every)
    return out


def preflight(domain: Domain, title, url, both, t: Columns):
    """Why a page isn't fetched, by lower-cased title, url and the two together; 'pass' if nothing speaks against it."""
    anchor = t.any(title, domain.anchors)
    noise = t.either(t.any(title, domain.noise), t.any(both, domain.noise))
    return t.first([
        (t.words(title, lexicon.TRADE_TITLE_STOP), "no news"), (t.endings(url, lexicon.TRADE_EXTENSIONS), "document"),
        (t.both(noise, t.no(t.both(anchor, signal(domain, title, t)))), "noise"), (t.both(t.any(title, "trade_elsewhere"), t.no(anchor)), "elsewhere"),
    ], "pass")


def lexical(domain: Domain, text, t: Columns):
    """The reason by which a text (title and content, lower case) is kept or refused. The non-profit job looks for other
    matters first, the trade job for the place."""
    anchor, topic = t.any(text, domain.anchors), signal(domain, text, t)
    place = (t.no(t.either(anchor, t.any(text, "trade_districts"))), "no place")
    elsewhere = (t.both(t.any(text, "trade_elsewhere"), t.no(anchor)), "elsewhere")
    noise = (t.both(t.any(text, domain.noise), t.no(t.both(anchor, topic))), "noise")
    refused = [place, elsewhere, noise] if domain is TRADE else [noise, elsewhere, place]
    return t.first([*refused, (topic, "topic")], "poor")


#: Reasons with which a text is kept.
KEPT = ("topic", "poor")


def labour_preflight(title, url, score, t: Columns):
    return t.first([(t.endings(url, lexicon.TRADE_EXTENSIONS), "document"), (t.words(title, LABOUR_TITLE_STOP), "no news"), (score, "low score")], "pass")
