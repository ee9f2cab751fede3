"""URL filters: rules by host and path, and for the rest a naive Bayes over words that Viterbi cuts host names into.

A name (a run of letters of a host, or of a path) is split into the words that are likeliest together by a unigram
model. Its words come from a vocabulary file that is given by path and read on the driver, at most MOST_WORDS of them;
the chance of a word follows from its rank by Zipf's law. A run that no words make up is a word of its own, at a cost
per letter. Multinomial naive Bayes, trained on labelled addresses that are split in the same way, scores the words of
host and path that it knows.

Work is per distinct host and path, in Arrow batches; nothing shuffles. A null url, or one without `://`, has an empty
host and path, fits no rule and is allowed, as is every url without a word that the classifier knows. Repeated rows get
equal verdicts; urls of any length are split whole; an empty table has an empty result; extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import LOWER, UPPER, table

#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with its own; the longest wins.
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
#: A vocabulary of word pieces in the order of their frequency; `</w>` ends a word.
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
MOST_WORDS = 50_000
#: Words of one and two letters that names are split at; other short pieces aren't words.
SHORT = set("a i ad ai am an as at be by do go he if in is it me my no of on or pc so to tv uk up us we".split())
#: A url that no rule fits is blocked from this score on.
MOST = 0.8
#: Parts of addresses that say nothing.
NEUTRAL = {"www", "m", "blog", "com", "net", "org", "html", "htm", "php", "index", "page", "ref", "utm", "en", "de", "fr", "es", "example"}

#: Labelled addresses, by kind.
BLOCKED = {
    "gambling": "grandcasinoroyal casinobonuscodes mycasinoguide/slots pokerroomonline pokerstakes/bonus bettingtips247 sportsbetting/odds livebets placebets/now onlinebets bingojackpot slotmachines/spins luckyspins roulettewheel jackpotwinners/win winbigmoney lotterywinners/win",
    "adult": "adultvideos adultchat/cam xxxmovies pornclips freeporn/videos sexcams sexdating/tonight nudegirls hotescorts escortservice webcamgirls/live eroticstories hookupsnow/adult",
    "pharmacy": "cheapmeds cheappharmacy/pills buypillsonline pillstore/discount discountviagra viagrapills/buy genericcialis/cheap pharmacynorx weightlosspills/miracle dietpills/buy steroidshop buymeds/cheap",
    "piracy": "torrentdownloads torrentz/crack crackedsoftware/keygen keygenserial warezforum freemovies/download pirateproxy serialkeys/crack nulledscripts mp3downloads/free",
    "scam": "paydayloans/fast fastcash/loan quickloans easymoney/home getrichquick freegiftcards/claim claimyourprize prizewinner/claim bitcoindoubler cryptogiveaway/claim replicawatches fakedesigner/cheap cheapreplica essaywriters/cheap",
    "malware": "secureloginverify/account accountverify/login phishingkit malwaredrop/exe updateflashplayer/exe virusalert/scan hackaccounts passwordhack/free spywareremover/free freeantivirus/scan trojanhorse/exe",
    "tracking": "adserver/click adstracker adtracking/pixel clicktracker/pixel bannerads/popup popunderads trackingpixel popupads/click adsnetwork/banner doubleclicks/ads affiliateclicks/track trafficexchange/track",
    "spam": "linkfarm spamlinks seospam/links buybacklinks cheapbacklinks/seo articlespinner bulkemail/spam spammers/farm contentfarm doorwaypages/seo commentspam autoblog/spin",
}
ALLOWED = {
    "news": "dailynews morningpost/news worldreport/politics localnews/city eveninggazette thetimes/opinion radionews/live newsarchive/article financialjournal/markets weatherforecast/today",
    "education": "stateuniversity/courses communitycollege openlibrary/books highschool/students learnlanguages mathforum/lessons physicsdepartment/research studentguide teachersresources/lesson campuslife onlinecourse/lecture",
    "science": "sciencejournal/article researchlab/papers naturemagazine astronomyclub spaceexplorer geologymuseum/exhibits datascience/tutorial marinebiology/reef climatecenter/report",
    "public": "citycouncil/meeting nationalpark/visit publichealth/advice taxoffice/forms parliament/bills firedepartment/safety countylibrary/events museumofart/exhibits historysociety/archive courthouse/records",
    "health": "healthcenter/clinic childrenshospital/doctors familydoctor/appointments nursingcare dentalclinic mentalhealth/support medicaljournal/study heartfoundation",
    "home": "gardenguide/plants recipebook/dinner cookingschool/bread homerepair/tools craftideas bakingblog/cake furnitureshop/tables housedesign/kitchen coffeehouse/menu teagarden",
    "leisure": "travelguide/hotels mountainhiking/trails riverfishing birdwatching/guide chessclub/games footballclub/results runningclub/training musicreview/albums filmfestival/program bookreview/novels photoalbum/family theaterseason/tickets",
    "technology": "opensource/docs programmingblog/python computerhelp/support linuxforum/questions codesamples/manual webdesign/tutorial softwareengineering/blog databasemanual/reference hardwarereview/laptops",
    "business": "marketreport/analysis energyreview lawoffice/contact insurancecompany/policy carreview/models bikeshop/repairs bookstore/catalog flowershop/delivery realestate/houses bankbranch/contact engineeringfirm/projects",
}


@dataclass(frozen=True)
class Model:
    """Log chances of words, and of the words that labelled addresses hold their log likelihoods (blocked, allowed)."""

    unigram: dict[str, float]
    likelihood: dict[str, tuple[float, float]]

    def unknown(self, n: int) -> float:
        return -9.0 - 2.6 * n

    def segment(self, name: str) -> list[str]:
        """The likeliest words of a name by Viterbi."""
        n, get = len(name), self.unigram.get
        best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
        for j in range(1, n + 1):
            for i in range(max(0, j - 24), j):
                score = best[i] + get(name[i:j], self.unknown(j - i))
                if score > best[j]:
                    best[j], back[j] = score, i
        words: list[str] = []
        while n:
            words.append(name[back[n] : n])
            n = back[n]
        return words[::-1]

    def tokens(self, host: str, path: str) -> list[str]:
        """Words of the host's and the path's names, A-Z in lower case, without neutral ones."""
        names = [x for x in re.split(r"[^a-z]+", f"{host}/{path}".translate(_LOWER)) if x and x not in NEUTRAL]
        return [w for name in names for w in self.segment(name) if w not in NEUTRAL]

    def blocked(self, host: str, path: str) -> float:
        """Probability of the blocked class, with equal priors; 0.5 without any known word."""
        known = [self.likelihood[w] for w in self.tokens(host, path) if w in self.likelihood]
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, sum(b - g for b, g in known)))))


_LOWER = str.maketrans(UPPER, LOWER)


def unigrams(vocabulary: str = VOCABULARY) -> dict[str, float]:
    """Log chances of the words of a vocabulary file, by their rank."""
    with open(vocabulary, encoding="utf-8") as f:
        pieces = json.load(f)["model"]["vocab"]
    words = [p.removesuffix("</w>") for p, _ in sorted(pieces.items(), key=lambda x: x[1]) if re.fullmatch("[a-z]+</w>", p)]
    words = [w for w in words if len(w) > 2 or w in SHORT][:MOST_WORDS]
    total = sum(1 / (r + 2.7) for r in range(len(words)))
    return {w: -math.log((r + 2.7) * total) for r, w in enumerate(words)}


def labelled_urls() -> list[tuple[str, str, bool]]:
    """(host, path, whether it is blocked) of the labelled addresses."""
    each = [(a, blocked) for kinds, blocked in ((BLOCKED, True), (ALLOWED, False)) for line in kinds.values() for a in line.split()]
    return [(*(a.split("/", 1) + [""])[:2], blocked) for a, blocked in each]


def train(unigram: dict[str, float], labelled: list[tuple[str, str, bool]] | None = None) -> Model:
    """Multinomial naive Bayes of the labelled addresses, split by the unigram model; the labelled list is the driver's, so it is bounded."""
    splitter = Model(unigram, {})
    counts = {True: Counter(), False: Counter()}
    for host, path, blocked in labelled if labelled is not None else labelled_urls():
        counts[blocked].update(splitter.tokens(host, path))
    vocabulary = set(counts[True]) | set(counts[False])
    log = lambda c, w: math.log((c[w] + 0.5) / (sum(c.values()) + 0.5 * (len(vocabulary) + 1)))
    return Model(unigram, {w: (log(counts[True], w), log(counts[False], w)) for w in vocabulary})


@lru_cache(4)
def default_model(vocabulary: str = VOCABULARY) -> Model:
    return train(unigrams(vocabulary))


def scorer(spark: SparkSession, model: Model):
    """A column function from host and path to the blocked class's probability. The model, of bounded size, is sent to each executor once."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def score(host: pd.Series, path: pd.Series) -> pd.Series:
        known, one = {}, sent.value.blocked
        for key in zip(host, path.str.replace(r"\d+", "", regex=True), strict=True):
            if key not in known:
                known[key] = one(*key)
        return pd.Series([known[key] for key in zip(host, path.str.replace(r"\d+", "", regex=True), strict=True)], dtype="float64")

    return score


def parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path of a url."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, UPPER, LOWER), path


def judged(pages: DataFrame, rules: list[tuple] = RULES, model: Model | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and the classifier's score."""
    score = scorer(pages.sparkSession, model or default_model())
    host, path = parts(F.col("url"))
    cut = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((F.col("host") == h) | F.endswith("host", F.lit(f".{h}"))) & F.startswith("path", F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    scored = cut.withColumn("score", score("host", "path"))
    return scored.select("page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("score") >= MOST, "block").otherwise("allow")).alias("verdict"), "score")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
