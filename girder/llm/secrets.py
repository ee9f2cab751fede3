"""Secret scans: candidates by pattern, and a random forest that removes the false ones.

Candidates are values assigned to a telling name, or to a longer name that holds one, and long opaque runs with a digit.
They are cut out of the whole text by one projection, with what stands before and after them; the text itself goes no
further. The forest looks at a candidate's length, its transitions between kinds of characters, how much of it words of
a dictionary cover, whether it is part of a path, and the words before and after. It is trained on labelled findings:
texts in which one value is marked as a secret or not, those given or else a fixed set of lines as they stand in
configurations, code and logs. Their candidates are found and described as those of the documents are. All of it is
built-in functions and Spark's own forest; nothing shuffles.

A null or empty text has no candidates, and a table without texts no findings. Repeated rows get equal findings.
Candidates don't overlap; of two that do the earlier one counts. Texts of any length are searched whole. Columns besides
doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import json
import random
import re
import string

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import delete, drop, laid_out, let, shared_dir, table, written

#: What stands between a name and its value; a name, which may be part of a longer one, up to its value; a value.
SIGN = r"""[=:]=?=?>?\s*\\?["']?(?:(?i:bearer|basic)\s+)?"""
NAME = r"""(?i:(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]++\\?["']?\]?\s*[=:])(?>[A-Za-z0-9_-]*?(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth|credential))[A-Za-z0-9_-]*+\\?["']?\]?\s*)"""
VALUE = r"""[^\s"']{6,}"""
ASSIGNED = f"{NAME}{SIGN}{VALUE}"
OPAQUE = r"""(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{20,}"""
CANDIDATE = f"{ASSIGNED}|{OPAQUE}"
#: Characters before and after a candidate that are looked at.
CONTEXT = 48
#: A vocabulary of word pieces in the order of their frequency; `</w>` ends a word. Its most frequent words are the dictionary.
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
DICTIONARY = 1500
TELLING = r"(?i)(?:token|secret|passw|pwd|key|auth|bearer|credential)"
HARMLESS = r"(?i)(?:sha-?\d*|md5|checksum|digest|commit|revision|uuid|guid|hash|etag|version|build|example|sample|invoice|order|phone|isbn|request|trace|ids?|ref|base64|ssh-\w+|integrity|fingerprint|signature)\W{0,8}$"
UNREAL = r"(?i)your|my[_-]|example|sample|dummy|placeholder|change|insert|redacted|hidden|todo|undefined|^null|^none|^true|^false|x{4,}|\*{3,}|\.{3,}|abcdef|123456"
#: How values begin that well-known issuers hand out.
ISSUED = r"^(?:A[KS]IA[0-9A-Z]|gh[pousr]_|github_pat_|glpat-|xox[abpros]-|[rs]k[_-](?:live|test|[A-Za-z0-9])|SG\.|eyJ[A-Za-z0-9]|AIza|ya29\.|npm_|pypi-|dop_v1_|hf_|EAA[A-Z])"
CODE = r"[(){}\[\]<>$;]|\w\.\w|::|->"
FEATURES = ["length", "digits", "uppers", "lowers", "marks", "transitions", "variety", "mixed", "word_runs", "issuer", "is_hex", "dictionary", "vowels", "in_path",
    "unreal", "code", "telling", "harmless", "harmless_after", "called_after", "assigned", "quoted"]


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, start (in characters), kind, value, before, after: one row for each candidate."""
    text = F.col("text")
    cut = F.zip_with(F.split(text, CANDIDATE), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), lambda gap, m: F.struct(gap.alias("gap"), m.alias("m")))
    # each part with its neighbours: a match may be next to another
    ends = lambda x: F.concat(F.coalesce(x["gap"], F.lit("")), F.coalesce(x["m"], F.lit("")))
    after = lambda parts: F.zip_with(parts, F.slice(parts, 2, F.size(parts)), lambda x,
        y: F.struct(x["gap"].alias("gap"), x["m"].alias("m"), F.left(ends(y), F.lit(CONTEXT)).alias("after")))
    last = lambda x: F.right(F.concat(F.coalesce(x["before_gap"], F.lit("")), F.coalesce(x["x"]["gap"], F.lit(""))), F.lit(CONTEXT))
    both = lambda parts: F.zip_with(parts, F.concat(F.array(F.lit("")), F.transform(parts, lambda p: F.right(F.coalesce(p["m"], F.lit("")), F.lit(CONTEXT)))),
        lambda x, b: F.struct(x.alias("x"), b.alias("before_gap")))
    n = lambda c: F.coalesce(F.char_length(c), F.lit(0)).cast("long")
    place = lambda p, at: F.when(p["x"]["m"].isNotNull(),
        F.struct((at + n(p["x"]["gap"])).alias("at"), p["x"]["m"].alias("m"), last(p).alias("before"), p["x"]["after"].alias("after")))
    found = let(cut, lambda parts: let(after(parts),
        lambda x: let(both(x), lambda p: laid_out(p, lambda q: n(q["x"]["gap"]) + n(q["x"]["m"]), place, "struct<at:bigint,m:string,before:string,after:string>"))))
    each = docs.where(F.rlike(text, F.lit(CANDIDATE))).select("doc_id", F.explode(found).alias("c")).select("doc_id", "c.*")
    value = F.regexp_extract("m", f"^{NAME}{SIGN}({VALUE})$", 1)
    assigned = F.rlike("m", F.lit(rf"^(?:{ASSIGNED})$"))
    return each.select("doc_id", F.when(assigned, "assigned").otherwise("opaque").alias("kind"), F.when(assigned, value).otherwise(F.col("m")).alias("value"), "at",
        "m", "before", "after").select(
        "doc_id", (F.col("at") + F.char_length("m") - F.char_length("value")).cast("long").alias("start"), "kind", "value",
        F.concat("before", F.left("m", F.char_length("m") - F.char_length("value"))).alias("before"), F.coalesce("after", F.lit("")).alias("after"),
    )


def dictionary(vocabulary: str = VOCABULARY, n: int = DICTIONARY) -> list[str]:
    """The n most frequent words of four letters or more of a vocabulary file, longest first."""
    with open(vocabulary, encoding="utf-8") as f:
        pieces = json.load(f)["model"]["vocab"]
    words = [p.removesuffix("</w>") for p, _ in sorted(pieces.items(), key=lambda x: x[1]) if re.fullmatch("[a-z]{4,}</w>", p)][:n]
    return sorted([*words, "passwd", "auth", "token", "config", "secret", "param"], key=len, reverse=True)


def described(found: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """found with the FEATURES of value, before and after."""
    n = F.greatest(F.char_length("value"), F.lit(1))
    share = lambda pattern: F.regexp_count("value", F.lit(pattern)) / n
    yes = lambda condition: F.when(condition, 1.0).otherwise(0.0)
    features = {
        "length": n.cast("double"),
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "lowers": share("[a-z]"),
        "marks": share("[^A-Za-z0-9]"),
        "transitions": share("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "variety": F.size(F.array_distinct(F.split("value", ""))) / n,
        "mixed": share("[A-Za-z][0-9]+(?=[A-Za-z])"),
        "word_runs": 1 - F.char_length(F.regexp_replace("value", "[A-Z]?[a-z]{4,}", "")) / n,
        "issuer": yes(F.rlike("value", F.lit(ISSUED))),
        "is_hex": yes(F.rlike("value", F.lit("^(?:[0-9a-f]+|[0-9A-F]+)$"))),
        "dictionary": 1 - F.char_length(F.regexp_replace(F.lower("value"), "|".join(dictionary(vocabulary)), "")) / n,
        "vowels": share("[aeiouAEIOU]"),
        "in_path": yes(F.rlike("before", F.lit("[/.\\\\]$")) | F.rlike("value", F.lit("/.*/|^\\.{0,2}/|://"))),
        "unreal": yes(F.rlike("value", F.lit(UNREAL))),
        "code": yes(F.rlike("value", F.lit(CODE))),
        "telling": yes(F.rlike("before", F.lit(TELLING))),
        "harmless": yes(F.rlike("before", F.lit(HARMLESS))),
        "harmless_after": yes(F.rlike("after", F.lit(r"(?i)^\W{0,6}(?:is an? |# ?)?(?:example|sample|dummy|placeholder|fake|commit|checksum|not a (?:real|secret))"))),
        "called_after": yes(F.rlike("after", F.lit(r"^[(\[]|^\.\w"))),
        "assigned": yes(F.rlike("before", F.lit(f"{SIGN}$"))),
        "quoted": yes(F.rlike("before", F.lit("""["']$"""))),
    }
    return found.withColumns({k: v.cast("double") for k, v in features.items()})


#: Lines with a finding, as they stand in configurations, code and logs. A name in braces is made up by MADE.
SECRETS = """export AWS_SECRET_ACCESS_KEY={b64_40}|aws_access_key_id = {akia}|the key {akia} was in the log|password: {pw}|db.password={pw}|"password": "{pw}",|PGPASSWORD='{pw}' psql -h db|{word} password={hex18}
api_key = "{hex32}"|apiKey: '{alnum39}',|x-api-key: {alnum40}|-H "Authorization: Bearer {jwt}"|GITHUB_TOKEN={ghp}|git clone with {ghp} as user|slack_token: {xox}|stripe.api_key = "{sk}"|client_secret={alnum24}
client_secret: "{uuid}"|secret: {hex64}|auth_token = "{hex40}"|token = "{hex40}"|{word} token = "{hex40}" {word}|TOKEN = "{HEX40}"|private_token={alnum20}|secret_key_base: {hex128}|define('AUTH_KEY', '{marks64}');
credential={b64_40}|access_key: "{b64_40}"|passwd={pw}|pwd = "{pw}"|<add key="Password" value="x"/> pwd={pw}|$password = '{pw}';|authToken:"{alnum32}"|npm config set _authToken={alnum36}|redis auth={alnum16}
{word} {word} {akia} {word}|{word} {sk} {word}|found {xox} in {word}""".replace("\n", "|").split("|")
HARMLESS_LINES = """password = get{Word}Password(user1)|password = {word}.getPassword();|token = request.headers["x-auth-token"]|password=${DB_PASSWORD}|password: <your-password>|password: {{ vault_password_{n} }}|api_key = YOUR_API_KEY_{n}
api_key="your_api_key_here"|secret: changeme{n}|token_type=bearer{n}|auth = HTTPBasicAuth(user,pw)|password: ********|secretName: {word}-{word}-secret|authMethod=basic_auth_v{n}|keyfile_password_path=/etc/ssl/private/{word}.key
password_reset_url=https://{word}.example.com/reset/{n}|token: undefined{n}|secret = None{n}xx|password = os.environ["DB_PASS"]|this.token = tokenService.{word}Token()|password_field = form.{word}Password{n}|auth: {word}Auth{Word}
tokenizer = {word}_{word}_tokenizer|max_tokens = maximum{n}|password: string().min(8)|secret: process.env.SECRET{n}|authority = {word}.{word}.com|commit {hex40}|Merge commit {hex40} into main|sha256:{hex64}|md5 {hex32}|checksum = {hex64}
etag: "{hex32}"|uuid {uuid}|request id {uuid} took {n} ms|trace={uuid}|integrity="sha512-{b64_86}=="|revision {hex40}|image digest {hex64}|build 20240312.{digits20}|order {digits20}|phone +{digits20}|{word} {digits24}
https://{word}.example.com/{word}/{word}-{word}-{word}/{n}|see /usr/lib/python3/dist-packages/{word}_{word}/{word}{n}.py|com.example.{word}.{Word}{Word}{Word}Service{n}|class {Word}{Word}{Word}{Word}{Word}{n}|css-{word}-{word}-{word}-{n}
data:image/png;base64,iVBORw0KGgo{b64_86}|ssh-rsa AAAAB3NzaC1yc2EAAAADAQABAAABAQ{b64_86}|abcdefghijklmnopqrstuvwxyz0123456789|12345678901234567890123456|{word}{word}{word}{word}{word}{n}|{word}_{word}_{word}_{word}_{n}
=========================={n}|--------------------------{n}|{word}-{word}-{word}-{word}-{n}|fingerprint {hex40}|signature={hex64}|file {word}/{word}/{word}_{word}_{n}|utf8mb4_general_ci_{word}_{n}|{Word}{Word}{Word}{Word}Factory{n}
token: {alnum24} # example|password = {word}{n} // placeholder""".replace("\n", "|").split("|")


def made(template: str, rng: random.Random, words: list[str]) -> tuple[str, str]:
    """A line of a template, and the longest value that was made up for it (the line, if none was)."""
    run = lambda alphabet, k: "".join(rng.choices(alphabet, k=k))
    hexes, alnum = "0123456789abcdef", string.ascii_letters + string.digits
    values: list[str] = []

    def fill(m: re.Match) -> str:
        name = m[1]
        n = int(re.sub(r"\D", "", name.removeprefix("b64")) or 0)
        if name in ("word", "Word"):
            return rng.choice(words) if name == "word" else rng.choice(words).capitalize()
        if name == "n":
            return str(rng.randint(1, 9999))
        kinds = {
            "hex": lambda: run(hexes, n), "HEX": lambda: run(hexes, n).upper(), "alnum": lambda: run(alnum, n), "digits": lambda: run(string.digits, n),
                "b64_": lambda: run(alnum + "+/", n), "marks": lambda: run(alnum + "!#%&*+-^_~", n),
            "uuid": lambda: "-".join(run(hexes, k) for k in (8, 4, 4, 4, 12)), "akia": lambda: "AKIA" + run(string.ascii_uppercase + string.digits, 16),
                "ghp": lambda: rng.choice(["ghp_", "gho_"]) + run(alnum, 36),
            "xox": lambda: f"xoxb-{run(string.digits, 11)}-{run(string.digits, 12)}-{run(alnum, 24)}",
                "sk": lambda: rng.choice(["sk_live_", "sk-", "rk_live_"]) + run(alnum, rng.choice([24, 32])),
                "jwt": lambda: f"eyJ{run(alnum, 33)}.eyJ{run(alnum, 60)}.{run(alnum + '-_', 43)}",
            "pw": lambda: rng.choice([rng.choice(words).capitalize() + str(rng.randint(10, 2030)) + rng.choice("!#?*") * rng.randint(0, 1),
                run(alnum + "!#%*-_", rng.randint(8, 20)), f"{rng.choice(words)}-{run(hexes, 4)}-{rng.randint(10, 99)}"]),
        }
        values.append(kinds[re.sub(r"\d+$", "", name)]())
        return values[-1]

    line = re.sub(r"\{(\w+)\}", lambda m: fill(m) if m[1] != "DB_PASSWORD" else m[0], template)
    return line, max(values, key=len, default="")


def labelled_findings(n: int = 4000, seed: int = 5, templates: tuple = (SECRETS, HARMLESS_LINES)) -> list[tuple[int, str, str, float]]:
    """(doc_id, text, marked value, 1.0 if a secret): n lines among words; where no value is marked, all candidates of the line are meant."""
    rng = random.Random(seed)
    words = sorted(dictionary())
    out = []
    for i in range(n):
        label = i % 2
        line, value = made(rng.choice(templates[1 - label]), rng, words)
        around = lambda: " ".join(rng.choices(words, k=rng.randint(0, 6)))
        out.append((i, f"{around()} {line} {around()}", value, float(label)))
    return out


def trained_on(findings: DataFrame) -> DataFrame:
    """The candidates of labelled findings (doc_id, text, marked, label), described, with label; those that aren't meant are left out."""
    found = candidates(findings).join(F.broadcast(findings.select("doc_id", "marked", "label")), "doc_id")
    meant = F.contains("value", F.col("marked")) | F.contains("marked", F.col("value"))
    return described(found.where(meant))


def forest(findings: DataFrame) -> PipelineModel:
    """Trained on labelled findings (doc_id, text, marked, label); they are given by the caller, so they are bounded."""
    stages = [VectorAssembler(inputCols=FEATURES, outputCol="features"), RandomForestClassifier(labelCol="label", numTrees=60, maxDepth=6, seed=7, subsamplingRate=0.8)]
    path = shared_dir(findings.sparkSession, "forest")
    rows = written(trained_on(findings).select("label", *FEATURES), "findings")
    Pipeline(stages=stages).fit(rows.coalesce(1).sortWithinPartitions("label", *FEATURES)).save(path)  # in one order, as trees draw rows by their place
    drop(rows)
    model = PipelineModel.load(path)  # without its training summary, which holds the session and so can't always be sent to executors
    delete(findings.sparkSession, path)
    return model


def secrets(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """doc_id, start, kind, value, score and is_secret of each candidate."""
    if findings is None:
        findings = docs.sparkSession.createDataFrame(labelled_findings(), "doc_id long, text string, marked string, label double")
    scored = forest(findings).transform(described(candidates(docs.select("doc_id", "text"))))
    score = vector_to_array(F.col("probability"))[1]
    return scored.select("doc_id", "start", "kind", "value", score.alias("score"), (score >= 0.5).alias("is_secret"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", F.char_length("value").cast("long").alias("n_chars"), "kind", F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")
