"""Template residue, filler and error notices in place of reported text (problem 4).

Character n-gram models of natural prose and of residue score every place of a text. The residue model starts from the
seed texts below; lines it then claims are taken out of the prose model and added to it, and both are fitted again over
all texts. Windows of high likelihood ratio localise residue. A line mostly covered by windows is residue, and a text
is left out if it has such a line. Short windows inside sentences are residue if a slot of template syntax, or the word
a failed slot leaves, stands there.
"""

from __future__ import annotations

import builtins
import re
from collections import Counter
from collections.abc import Iterator
from http import HTTPStatus

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexaudit.session import materialize

# What the residue model starts from. Filler text in Latin as printers use it, and sentences of the kind that
# editors' tools and templates put where text is to come, in general words.
FILLER = """
lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua
ut enim ad minim veniam quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat
duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur
excepteur sint occaecat cupidatat non proident sunt in culpa qui officia deserunt mollit anim id est laborum
ini adalah contoh teks untuk mengisi ruang kosong pada halaman
gantilah teks contoh ini dengan naskah yang sebenarnya
masukkan judul artikel pada kolom ini dan isi artikel pada kolom di bawahnya
silakan sunting paragraf percobaan ini melalui dasbor pengelola situs
isi halaman akan segera kami lengkapi
teks sementara, belum final, jangan diterbitkan
uji coba penerbitan, abaikan tulisan ini
this is only sample text that fills an empty area of the layout
replace this text with your own words before you publish
enter a heading for the article in this field and its body in the next one
content is coming soon
for testing purposes only, please ignore this post
qwertyuiop asdfghjkl zxcvbnm
blah blah blah
"""
# Messages of servers, gateways, browsers' checks and scripts, in general words.
NOTICES = """
maaf, kami tidak dapat menemukan halaman yang anda tuju di situs ini
alamat yang anda ketik salah atau halamannya telah kami hapus
terjadi galat pada peladen kami, cobalah lagi nanti
peladen tidak menanggapi permintaan anda
layanan untuk sementara tidak tersedia karena perawatan sistem
anda tidak memiliki izin untuk mengakses halaman tersebut
permintaan anda kami blokir demi keamanan. kode kejadian: 8f3a91c2
mohon menunggu, isi halaman masih dimuat
sebelum melanjutkan, peramban anda perlu kami periksa dahulu
selesaikan pemeriksaan keamanan untuk membuktikan bahwa anda manusia
centang kotak untuk menunjukkan bahwa anda bukan program otomatis
masa berlaku sesi anda telah habis, silakan login kembali
tautan yang anda buka tidak berlaku lagi
tulisan ini sudah ditarik oleh penerbit
javascript di peramban anda belum aktif, hidupkan javascript agar situs dapat ditampilkan
situs ini membutuhkan javascript
peramban lama tidak didukung, perbarui peramban anda
nonaktifkan pemblokir iklan anda untuk melanjutkan membaca
kembali ke halaman utama atau gunakan pencarian
sorry, we could not find the page you were looking for
something went wrong on our end, please try again later
the server is temporarily unable to service your request due to maintenance
you do not have permission to view this directory
your request was blocked by the security policy. incident id: 8f3a91c2
hold on while the page is loading
we need to make sure that you are not a robot, complete the security check to continue
your session has timed out, log in again
this link has expired
you need javascript enabled in your browser to use this site
javascript is disabled, turn it on and reload the page
disable your ad blocker to continue reading
fatal error: uncaught exception: call to a member function on null in /var/www/html/index.php on line 42
notice: undefined index: content in /var/www/html/page.php on line 7
could not connect to the database server: connection refused
you have an error in your sql syntax near 'select' at line 1
sqlstate[42s02]: base table or view not found
traceback (most recent call last): file "app.py", line 42, in render
exception in thread "main" java.lang.illegalstateexception: no value present
at com.example.web.pagecontroller.show(pagecontroller.java:42)
typeerror: cannot read properties of undefined (reading 'title')
referenceerror: body is not defined
template error: could not render block
"""
#: Names in slots of the seeds, of the kind that programs use; those of the corpus are learned from it.
SLOT_NAMES = "title name date author body_text price user.name item_count first_name page.title city_name".split()
#: The errors a language's library names are errors in print as well.
_ERRORS = "\n".join(f"{k.lower()}: 'x'" for k, v in vars(builtins).items() if isinstance(v, type) and issubclass(v, Exception))
#: Codes and phrases of the protocol's error answers, as servers print them.
_STATUS = "\n".join(f"{x.value} {x.phrase.lower()}\nerror {x.value}\n{x.value} - {x.phrase.lower()}\ngalat {x.value}" for x in HTTPStatus if x.value >= 400)
_N = r"[^\W\d_][\w.]{0,40}"
#: Marks that stand for slots whatever the name.
_SURE = re.compile(rf"\{{\{{\s*({_N})\s*\}}\}}|\$\{{\s*({_N})\s*\}}|%%\s*({_N})\s*%%|@@\s*({_N})\s*@@|\[\[\s*({_N})\s*\]\]|<%=?\s*({_N})\s*%>|«\s*({_N})\s*»|__({_N})__|\{{%\s*({_N})[^%]*%\}}")
#: Marks that stand for slots only around a name that stands between sure marks elsewhere in the corpus, or one with an
#: underscore or full stop in it.
_LIKELY = re.compile(rf"(?<!\w)(?:\{{\s*({_N})\s*\}}|\[\s*({_N})\s*\]|<\s*({_N})\s*>|\$({_N})\$|#({_N})#|%({_N})%)(?!\w)")
#: Of slots and missing values, those that no other writing has, whatever the models say: the texts' languages quote by
#: other marks than «».
_PRINTED = re.compile(rf"(?<![\w.])(?:NaN|\[object Object\])(?![\w.])|\{{\{{\s*{_N}\s*\}}\}}|\$\{{\s*{_N}\s*\}}|%%\s*{_N}\s*%%|@@\s*{_N}\s*@@|<%=?\s*{_N}\s*%>|«[a-z_.]+»")
_MARKS = re.compile(r"\{\{|\$\{|%%|@@|\[\[|<%|«|__|\{%")
#: What languages print for a missing value, and a failed slot leaves inside a sentence.
_FAILED = re.compile(r"(?<![\w.])(?:undefined|null|nan|none|\[object object\])(?![\w.])", re.I)

N, BUCKETS = 4, 1 << 16
#: n-grams of a window; mean log ratio that makes it residue; share of a line it takes; the same of a slot's window.
WINDOW, RATIO, COVER, SLOT_WINDOW, SLOT_RATIO = 20, 0.35, 0.6, 5, 0.0
#: Weight of the seed texts, in n-grams, and share of the residue model that is spread evenly, for texts of no language.
SEED_WEIGHT, EVEN, KNOWN_EVEN = 60_000, 0.35, 0.01
#: Mean log ratio at which a line is taken into the residue model.
CLAIM = 0.6


_SPACES, _DIGITS = re.compile(r"[^\S\n]{2,}|[^\S\n ]"), re.compile(r"\d+")
#: Tags of a text, which are no residue however strange their words; those with a mark at both ends are slots.
_HASHTAG = re.compile(r"#\w+(?![\w#.])")


class Lines:
    """The lines of some texts that aren't blank, with the n-grams of all of them in one array.

    A line is scored in lower case, with one space between words, digits and the site's name alike, without tags and without the
    marks around it.
    """

    def __init__(self, texts: list[str], sites: list[str] | None = None) -> None:
        self.text, self.number, canonical = [], [], []
        for k, t in enumerate(texts):
            s = _DIGITS.sub("0", _SPACES.sub(" ", t.lower()))
            if sites and sites[k]:
                s = s.replace(sites[k], "~")
            if "#" in s:
                s = _HASHTAG.sub("", s)
            for number, line in enumerate(s.split("\n"), 1):
                line = line.strip(" *-»…!.\r")
                if line:
                    self.text.append(k)
                    self.number.append(number)
                    canonical.append(f" {line} ")
        self.canonical = canonical
        self.sizes = np.array([len(x) - N + 1 for x in canonical], dtype=np.int64)
        # lines are set apart so that no n-gram spans two; what does is left out
        joined = "".join(canonical)
        lengths = self.sizes + (N - 1)
        short = self.sizes < 1
        self.sizes[short] = 0
        g = _hashes(joined)
        starts = np.concatenate(([0], np.cumsum(lengths)))[:-1] if len(lengths) else np.zeros(0, dtype=np.int64)
        keep = np.zeros(len(joined) + 1, dtype=np.int64)
        np.add.at(keep, starts[~short], 1)
        np.add.at(keep, (starts + self.sizes)[~short], -1)
        self.grams = g[np.cumsum(keep)[: len(g)] > 0] if len(g) else g
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))


def _hashes(text: str) -> np.ndarray:
    """The bucket of every run of N characters."""
    c = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    n = len(c) - N + 1
    if n < 1:
        return np.empty(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        h = c[:n].copy()
        for k in range(1, N):
            h *= np.uint32(0x9E3779B1)
            h += c[k : k + n]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        h *= np.uint32(0xC2B2AE35)
    h >>= np.uint32(16)
    return h.astype(np.int64)


def _seed_counts() -> np.ndarray:
    counts = np.zeros(BUCKETS)
    slots = "\n".join(m.replace("x", n) for n in SLOT_NAMES for m in ("{{ x }}", "{{x}}", "${x}", "%%x%%", "@@x@@", "[[x]]", "<%= x %>", "«x»", "__x__", "{x}", "[x]", "<x>", "$x$", "#x#"))
    values = "undefined\nnull\nnan\nnone\n[object object]\n{}\n[]\nundefined undefined\nnull null"
    kinds = (FILLER, NOTICES, "\n".join((_STATUS, _ERRORS, values)), slots)
    for kind in kinds:
        own = np.zeros(BUCKETS)
        own += np.bincount(Lines([kind]).grams, minlength=BUCKETS)
        counts += own * (SEED_WEIGHT / len(kinds) / own.sum())
    return counts


def log_ratios(prose: np.ndarray, residue: np.ndarray) -> np.ndarray:
    """log P(n-gram | residue) - log P(n-gram | prose) by bucket: in row 0 with the EVEN share, in row 1 nearly without.

    Row 1 is for short lines: a lone rare word is like no language, but that makes it no residue. Empty corpora give
    the ratio of the seeds to nothing.
    """
    p = (prose + 0.5 / BUCKETS * 1000) / (prose.sum() + 500)
    r = _seed_counts() + residue / max(1.0, residue.sum()) * SEED_WEIGHT
    rows = [(1 - even) * r / r.sum() + even / BUCKETS for even in (EVEN, KNOWN_EVEN)]
    return (np.log(rows) - np.log(p)).astype(np.float32)


#: A line of at most so many characters that this share of all texts and several sources hold may be furniture of the
#: sites: it is residue only if it is like known residue, not for being unlike prose, and takes no part in fitting it.
#: Only texts of some length count: a notice in a page's place stands alone or nearly so.
FURNITURE_CHARS, FURNITURE_SHARE, FURNITURE_LEAST, FURNITURE_TEXT, FURNITURE_SOURCES = 80, 0.005, 4, 500, 2


#: Share of all texts, and texts at least, in which a name stands between sure marks to be a slot's name anywhere.
NAME_SHARE, NAME_LEAST = 1e-5, 2


class Model:
    """log ratios by bucket, the furniture lines, which at most lines-a-text / FURNITURE_SHARE different ones can be, and the
    names of slots, at most slots-a-text / NAME_SHARE."""

    def __init__(self, ratios: np.ndarray, furniture: frozenset[str], names: frozenset[str]) -> None:
        self.ratios, self.furniture, self.names = ratios, furniture, names


def _site(source: str) -> str:
    """The word of a source's address that names the site."""
    return source.split(".")[0]


def count_ngrams(texts: DataFrame) -> DataFrame:
    """bucket, line, source, n: counts of n-grams over all texts(text, source), the texts of each source that hold each
    short line (bucket -1), the texts (bucket -2), and the texts with each
    name between sure marks (bucket -3). Tasks add up their own counts before anything is shuffled."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, total = np.zeros(BUCKETS, dtype=np.int64), 0
        for b in batches:
            own, sources = b["text"].tolist(), b["source"].tolist()
            lines = Lines(own, list(map(_site, sources)))
            grams += np.bincount(lines.grams, minlength=BUCKETS)
            held = Counter((x, sources[k]) for k, x in {(k, x) for k, x in zip(lines.text, lines.canonical) if len(x) <= FURNITURE_CHARS and len(own[k]) >= FURNITURE_TEXT})
            names = Counter(x for t in own for x in _sure_names(t))
            rows = [(-1, x, s, n) for (x, s), n in held.items()] + [(-3, x, "", n) for x, n in names.items()]
            yield pd.DataFrame(rows, columns=["bucket", "line", "source", "n"])
            total += len(b)
        k = np.flatnonzero(grams)
        yield pd.DataFrame([*((x, "", "", n) for x, n in zip(k.tolist(), grams[k].tolist())), (-2, "", "", total)], columns=["bucket", "line", "source", "n"])

    return texts.mapInPandas(count, "bucket bigint, line string, source string, n bigint").groupBy("bucket", "line", "source").agg(F.sum("n").alias("n"))


def _array(counted: DataFrame) -> np.ndarray:
    got = counted.where("bucket >= 0").toPandas()  # at most BUCKETS rows
    counts = np.zeros(BUCKETS)
    counts[got["bucket"]] = got["n"]
    return counts


#: How much lower the first model's bars are for a line to be looked at again.
FREER = 0.5
#: n-grams' worth of no evidence that a line has beside its own, so that a word or two prove little.
PRIOR = 5


def line_means(lines: Lines, ratios: np.ndarray, known: bool = False) -> np.ndarray:
    """The mean log ratio of each line, drawn towards 0 where the line is short; `known`: novelty counts for no line."""
    row = np.repeat(np.where((lines.sizes < WINDOW) | known, 1, 0), lines.sizes)
    sums = np.concatenate(([0.0], np.cumsum(ratios[row, lines.grams], dtype=np.float64)))
    return (sums[lines.starts[1:]] - sums[lines.starts[:-1]]) / (lines.sizes + PRIOR)


def _covered(lines: Lines, sums: np.ndarray, width: int, least: float) -> np.ndarray:
    """How many n-grams of each line lie in windows of its own whose mean is above `least`."""
    total = len(sums) - 1
    edge = np.zeros(total + 1, dtype=np.int64)
    if total >= width:
        hot = np.flatnonzero((sums[width:] - sums[:-width]) / width > least)
        line = np.searchsorted(lines.starts, hot, side="right") - 1
        hot = hot[hot + width <= lines.starts[line + 1]]
        np.add.at(edge, hot, 1)
        np.add.at(edge, hot + width, -1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(edge[:-1]) > 0)))
    return inside[lines.starts[1:]] - inside[lines.starts[:-1]]


def residue_lines(texts: list[str], sites: list[str], model: Model) -> list[tuple[int, int, str, float]]:
    """(text, line_no, kind, coverage) of the lines that are residue ("line") or hold a slot ("slot")."""
    lines, ratios = Lines(texts, sites), model.ratios
    if not len(lines.grams):
        return []
    sums = np.concatenate(([0.0], np.cumsum(ratios[0, lines.grams], dtype=np.float64)))
    cover = _covered(lines, sums, WINDOW, RATIO) / np.maximum(lines.sizes, 1)
    short = lines.sizes < WINDOW  # one window
    cover = np.where(short, (line_means(lines, ratios) > RATIO) & (lines.sizes > 0), cover)
    slots = _covered(lines, sums, SLOT_WINDOW, SLOT_RATIO) > 0
    slots |= short & (line_means(lines, ratios) > SLOT_RATIO)
    odd = {k for k, t in enumerate(texts) if _PRINTED.search(t)}
    known = line_means(lines, ratios, True)
    out = []
    for k in np.flatnonzero((cover >= COVER) | slots | np.isin(lines.text, list(odd))):
        t, number = lines.text[k], lines.number[k]
        line = texts[t].split("\n")[number - 1]
        if lines.canonical[k] in model.furniture and known[k] <= RATIO:
            cover[k] = 0.0  # what pages of several sites have in common isn't residue for being unlike prose
        slot = has_slot(line, model.names) if slots[k] or cover[k] >= COVER else bool(_PRINTED.search(line))
        if cover[k] >= COVER:
            out.append((t, number, "line", float(cover[k])))
        elif slot:
            out.append((t, number, "slot", float(cover[k])))
    return out


#: A line of at least so many n-grams with a mean log ratio below PROSE is natural prose. Where a page has none, and its
#: lines that aren't furniture have no more than ALONE n-grams, what stands there stands in the story's place.
PROSE, PROSE_LEAST, ALONE = -1.5, 60, 500


def _in_place(lines: Lines, means: np.ndarray, own: np.ndarray) -> np.ndarray:
    """By line, whether it stands in the place of a story: it is its page's own (no furniture), and the page has no prose."""
    of = np.array(lines.text, dtype=np.int64)
    many = int(of.max(initial=-1)) + 1
    prose = np.bincount(of, weights=own & (means < PROSE) & (lines.sizes >= PROSE_LEAST), minlength=many)
    size = np.bincount(of, weights=own * lines.sizes, minlength=many)
    return own & ((prose == 0) & (size <= ALONE))[of]


def suspicious(texts: list[str], sites: list[str], model: Model) -> list[tuple[int, int, bool, bool]]:
    """(text, line_no, claimed, in_place) of lines with any window that the model, a margin more freely used, takes for residue."""
    lines, ratios = Lines(texts, sites), model.ratios
    if not len(lines.grams):
        return []
    sums = np.concatenate(([0.0], np.cumsum(ratios[0, lines.grams], dtype=np.float64)))
    means = line_means(lines, ratios)
    hot = (_covered(lines, sums, WINDOW, RATIO - FREER) > 0) | (_covered(lines, sums, SLOT_WINDOW, SLOT_RATIO) > 0)
    hot |= (lines.sizes < WINDOW) & (means > SLOT_RATIO - FREER)
    odd = {k for k, t in enumerate(texts) if _PRINTED.search(t)}
    if odd:
        hot |= np.isin(lines.text, list(odd))
    own = np.array([x not in model.furniture for x in lines.canonical])
    in_place = _in_place(lines, means, own)
    hot |= in_place
    return [(lines.text[k], lines.number[k], bool(means[k] > CLAIM and own[k] or in_place[k]), bool(in_place[k])) for k in np.flatnonzero(hot)]


def _sure_names(text: str) -> set[str]:
    """The names between sure marks."""
    if not _MARKS.search(text):
        return set()
    return {next(g for g in m.groups() if g).lower() for m in _SURE.finditer(text)}


def has_slot(line: str, names: frozenset[str] = frozenset()) -> bool:
    if _SURE.search(line) or _FAILED.search(line):
        return True
    for m in _LIKELY.finditer(line):
        name = next(g for g in m.groups() if g).lower()
        if name in names or "_" in name.strip("_") or "." in name.strip("."):
            return True
    return False


def find_residue(articles: DataFrame) -> DataFrame:
    """article_id, line_no, kind, coverage of every residue line. NULL ids, NULL and empty content have none.

    The texts are gone over twice: to count, and to take out the lines that the first model finds suspicious at all.
    Of these, the lines it claims go over from the prose model to the residue model, and the second model decides.
    """
    source = F.coalesce(F.lower(F.trim("source")), F.lit("")) if "source" in articles.columns else F.lit("")
    texts = articles.select("article_id", F.col("content").alias("text"), source.alias("source")).where("article_id IS NOT NULL AND text IS NOT NULL AND text <> ''")
    counted = materialize(count_ngrams(texts), "ngrams")
    total = sum(r.n for r in counted.where("bucket = -2").collect())
    least = max(FURNITURE_LEAST, FURNITURE_SHARE * total)
    known = counted.where((F.col("bucket") == -3) & (F.col("n") >= max(NAME_LEAST, NAME_SHARE * total))).select("line").collect()
    names = frozenset(r.line for r in known)
    held = counted.where("bucket = -1").groupBy("line").agg(F.sum("n").alias("n"), F.count_if(F.col("source") != "").alias("sources"))
    frequent = held.where((F.col("n") >= least) & (F.col("sources") >= FURNITURE_SOURCES)).select("line").collect()
    furniture = frozenset(r.line for r in frequent if not has_slot(r.line, names))
    prose = _array(counted)
    sc = articles.sparkSession.sparkContext
    first = sc.broadcast(Model(log_ratios(prose, np.zeros(BUCKETS)), furniture, names))

    def suspect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, own, sites = b["article_id"].tolist(), b["text"].tolist(), list(map(_site, b["source"]))
            rows = [(ids[t], sites[t], n, own[t].split("\n")[n - 1], c, p) for t, n, c, p in suspicious(own, sites, first.value)]
            yield pd.DataFrame(rows, columns=["article_id", "source", "line_no", "text", "claimed", "in_place"])

    lines = materialize(texts.mapInPandas(suspect, "article_id bigint, source string, line_no int, text string, claimed boolean, in_place boolean"), "suspects")
    claimed = _array(count_ngrams(lines.where("claimed").select("text", "source")))
    second = sc.broadcast(Model(log_ratios(np.maximum(0, prose - claimed), claimed), furniture, names))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, numbers = b["article_id"].tolist(), b["line_no"].tolist()
            found = residue_lines(b["text"].tolist(), b["source"].tolist(), second.value)
            rows = [(ids[k], numbers[k], kind, c) for k, _, kind, c in found]
            decided = {k for k, *_ in found}
            rows += [(ids[k], numbers[k], "page", 1.0) for k in np.flatnonzero(b["in_place"].to_numpy(dtype=bool)).tolist() if k not in decided]
            yield pd.DataFrame(rows, columns=["article_id", "line_no", "kind", "coverage"])

    return lines.mapInPandas(decide, "article_id bigint, line_no int, kind string, coverage double")


def residue_articles(articles: DataFrame) -> DataFrame:
    """article_id of the articles to leave out."""
    return find_residue(articles).select("article_id").distinct()
