"""Secret scans: candidates by patterns, false positives removed by a random forest.

The forest sees a candidate's length, its character transitions, how much of it dictionary
words cover, the path of its document and the words around it.  It is trained on labelled
findings made by rule (``labelled_findings``, a bounded table) or given by the caller.
"""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import string

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TREES, DEPTH, SEED = 30, 8, 5
FINDINGS = 3_000
CUT = 0.5
LEAST = 6  # code points of an assigned value
AROUND = 48

# Words that make up identifiers and prose, and words that stand by secrets or by other long strings.
DICTIONARY = "about access account after alpha api app array auth base bearer before bin black blue book branch build cache call cat change class client code color commit common config copy count create data date day default delete demo dev doc dog down dummy each east end error event example exit fake false file find first fish foo for from get git good green group hash head hello help here home host html http image index info input into item java json key last left lib license light line link list load local log long main make map merge message method mode model module name net new next node not null number object old open option order out own page parent part pass password path place port print public python query read record red release right root run sample save script search secret select send server service set simple site size small some source start state stop string style system table tag task temp test text that the this time token tree true type under update upper url user value version view web white window with word work world write your zero".split()
NEAR_SECRET = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "credential", "private", "bearer", "authorization", "auth", "access_key", "client_secret")
NEAR_OTHER = ("sha", "sha1", "sha256", "md5", "checksum", "digest", "commit", "uuid", "guid", "example", "sample", "placeholder", "test", "dummy", "fake", "version", "integrity", "revision", "etag", "image", "sum")
PATHS = ("test", "example", "sample", "doc", "fixture", "mock", "vendor")
PLACEHOLDERS = re.compile(r"(?i)x{4,}|\.{3}|changeme|your[_-]|example|placeholder|<|\{\{|\$\{|(.)\1{5,}|1234567|abcdef0")

_NAMES = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|credential|access[_-]?key)"
_CANDIDATE = re.compile(
    r"(?P<key>-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z ]*PRIVATE KEY-----)?)"
    rf"|(?:{_NAMES}[\"']?\s*[=:]\s*)(?![\"']?-----BEGIN )"
    r"(?:\"(?P<double>(?:[^\"\\\r\n]++|\\.)*+)\"|'(?P<single>(?:[^'\\\r\n]++|\\.)*+)'|[\"']?(?P<set>[^\s\"',;]{6,}))"
    r"|://[^\s/:@\"'<>]*+:(?P<url>[^\s/@\"'<>]{3,}+)@(?=[A-Za-z0-9\[])"
    # A name with dots before it, as in some.long.property.password=..., is no part of the value.
    rf"|(?<![A-Za-z0-9+/_=.-])(?![A-Za-z0-9+/_.-]*?{_NAMES}[\"']?\s*[=:]\s*[\"']?[^\s\"',;]{{6}})"
    r"(?P<long>[A-Za-z0-9+/_=.-]{20,}+)"
)
_ADDRESS = re.compile(r"\S*[@.]\w\S*")
_WORDS = re.compile(r"[a-z][a-z0-9_-]*")
_KINDS = {c: k for k, cs in enumerate((string.ascii_lowercase, string.ascii_uppercase, string.digits)) for c in cs}


def candidates(text: str):
    """(start, end, how found) in code points: key, set (assigned; a quoted value up to its quote), url (a password in an address) or long."""
    for m in _CANDIDATE.finditer(text):
        how = m.lastgroup
        if how in ("double", "single"):
            if len(m[how]) >= LEAST:
                yield m.start(how), m.end(how), "set"
            continue
        if how == "long" and not (any(c.isdigit() for c in m[how]) and any(c.isalpha() for c in m[how])):
            continue
        yield m.start(how), m.end(how), how


def describe(value: str, before: str, after: str, path: str, how: str) -> list[float]:
    """The features of one candidate."""
    n, low = len(value), value.lower()
    kinds = [_KINDS.get(c, 3) for c in value]
    moves = [0.0] * 16
    for a, b in zip(kinds, kinds[1:], strict=False):
        moves[4 * a + b] += 1 / max(1, n - 1)
    counts = {c: value.count(c) for c in set(value)}
    entropy = -sum(k / n * math.log2(k / n) for k in counts.values())
    covered = bytearray(n)
    for word in DICTIONARY:
        at = low.find(word) if len(word) > 2 else -1
        while at >= 0:
            covered[at : at + len(word)] = b"\1" * len(word)
            at = low.find(word, at + 1)
    vowels = sum(c in "aeiou" for c in low) / n
    left, right = _WORDS.findall(_ADDRESS.sub(" ", before.lower()))[-4:], _WORDS.findall(_ADDRESS.sub(" ", after.lower()))[:4]
    near = lambda words, names: float(any(w in names or any(p in names for p in re.split("[_-]", w)) for w in words))
    where = path.lower()
    return [
        float(min(n, 400)), *moves, entropy, sum(covered) / n, vowels, float(bool(PLACEHOLDERS.search(value))),
        float(all(c in string.hexdigits for c in value)), float("-" in value), float("/" in value or "." in value), float(how == "set"), float(how == "key"), float(how == "url"), float(" " in value),
        near(left, NEAR_SECRET), near(left, NEAR_OTHER), near(right, NEAR_OTHER), *(float(p in where) for p in PATHS),
    ]


def labelled_findings(n: int = FINDINGS, seed: int = SEED) -> list[tuple[str, str, str, str, str, int]]:
    """(value, before, after, path, how, secret 0/1) made by rule, half of each."""
    rnd = random.Random(seed)
    pick = lambda chars, k: "".join(rnd.choice(chars) for _ in range(k))
    hexa, alnum = "0123456789abcdef", string.ascii_letters + string.digits
    prose = lambda: " ".join(pick(string.ascii_lowercase, rnd.randint(2, 9)) for _ in range(5))
    out = []
    for k in range(n):
        path = rnd.choice(["src", "app/config", "deploy", "notes", f"src{k % 40}", "web"])
        word = lambda: rnd.choice(DICTIONARY)
        if k % 20 == 3:
            body = "\n".join(base64.b64encode(rnd.randbytes(48)).decode() for _ in range(rnd.randint(3, 26)))
            kind = rnd.choice(["", "RSA ", "EC ", "OPENSSH "])
            out.append((f"-----BEGIN {kind}PRIVATE KEY-----\n{body}\n-----END {kind}PRIVATE KEY-----", f"{prose()} {rnd.choice(['', 'key: ', 'secret = '])}", prose(), path, "key", 1))
            continue
        if k % 10 == 1:  # in an address, or of words with digits and signs
            sign = lambda: rnd.choice("!#%&$?*") if rnd.random() < 0.5 else ""
            worded = rnd.choice([word, lambda: word().capitalize(), lambda: pick(string.ascii_lowercase, 5)])() + sign() + pick(string.digits, rnd.randint(1, 4)) + rnd.choice(["", pick(alnum, 3)]) + sign()
            value = rnd.choice([worded, pick(alnum + "!#%&", rnd.randint(8, 24))])
            if rnd.random() < 0.5:
                out.append((value, f"{prose()} {rnd.choice(['https', 'postgres', 'redis', 'ftp'])}://{rnd.choice([word(), ''])}:", f"@{word()}.{word()}:{rnd.randint(80, 9000)}/{word()}", path, "url", 1))
            else:
                value = value if rnd.random() < 0.5 else rnd.choice([f"{word()} {worded} {word()}", f"{word()} {word()} {worded}", f"{sign()}{worded}, {word()}"])
                out.append((value, f"{prose()} {rnd.choice(['password = ', 'db_password=', 'secret: '])}{rnd.choice(chr(34) + chr(39))}", prose(), path, "set", 1))
            continue
        if k % 2:
            how, name = rnd.choice([("set", "token = "), ("set", "password: "), ("set", "api_key="), ("set", "client_secret = "), ("long", "authorization bearer "), ("long", "the token is ")])
            value = rnd.choice([lambda: pick(hexa, rnd.choice((32, 40, 64))), lambda: pick(alnum, rnd.randint(20, 48)), lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16), lambda: "ghp_" + pick(alnum, 36), lambda: base64.b64encode(rnd.randbytes(rnd.randint(18, 40))).decode(), lambda: pick(alnum + "!#%&", rnd.randint(8, 18))])()
            how = "set" if len(value) < 20 else how
            out.append((value, f"{prose()} {name}", prose(), path, how, 1))
            continue
        what = rnd.randrange(10)
        words = rnd.choice("_-/.").join(rnd.choice(DICTIONARY) for _ in range(rnd.randint(4, 7)))
        if what == 0:
            row = (pick(hexa, rnd.choice((32, 40, 64))), f"{prose()} {rnd.choice(['commit', 'sha256', 'md5', 'checksum', 'revision'])} ", prose(), path, "long")
        elif what == 1:
            row = ("-".join(pick(hexa, m) for m in (8, 4, 4, 4, 12)), f"{prose()} {rnd.choice(['uuid', 'id', 'guid'])} ", prose(), path, "long")
        elif what == 2:
            row = (rnd.choice(["changeme", "your_password_here", "xxxxxxxxxxxx", "<your-token>", "${TOKEN}", "example_token_value"]), f"{prose()} password = ", prose(), path, "set")
        elif what == 3:
            row = (words + str(rnd.randint(1, 99)), prose() + " ", prose(), path, "long")
        elif what == 4:
            row = (rnd.choice(["get", "os", "config"]) + "." + rnd.choice(DICTIONARY) + f"_{rnd.choice(DICTIONARY)}", f"{prose()} token = ", prose(), path, "set")
        elif what == 5:
            row = (pick(alnum, rnd.randint(20, 40)), f"{prose()} {rnd.choice(['example', 'sample', 'dummy', 'test'])} token = ", prose(), rnd.choice(["tests/fixtures", "docs/example", "mock"]), "set")
        elif what == 6:
            row = (rnd.choice(["password", "pass", "<password>", "${PASS}", "PASSWORD", "changeme", word()]), f"{prose()} {rnd.choice(['https', 'postgres'])}://user:", f"@{word()}.com/{word()}", path, "url")
        elif what == 7:
            row = (" ".join(word() for _ in range(rnd.randint(2, 8))), f"{prose()} {rnd.choice(['password', 'token', 'secret'])}: \"", prose(), path, "set")
        elif what == 8:
            row = (base64.b64encode(rnd.randbytes(rnd.randint(18, 60))).decode(), f"{prose()} {rnd.choice(['data:image/png;base64,', 'sha256-', 'sum '])}", prose(), path, "long")
        else:
            row = (f"{rnd.randint(1, 28)}.mail{rnd.randint(1, 99)}.{words}.com", prose() + " ", prose(), path, "long")
        out.append((*row, 0))
    return out


def train(spark: SparkSession, findings: list[tuple] | None = None):
    """The forest over ``findings`` (value, before, after, path, how, secret); a bounded table."""
    rows = [(describe(*f[:5]), float(f[5])) for f in (findings or labelled_findings())]
    data = spark.createDataFrame(rows, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label")
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(data.repartition(2))


def _found(batches):
    for batch in batches:
        out = [[] for _ in range(7)]
        for doc, text, path in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "path")), strict=True):
            for start, end, how in candidates(text or ""):
                value = text[start:end]
                x = describe(value, text[max(0, start - AROUND) : start], text[end : end + AROUND], path or "", how)
                for column, v in zip(out, (doc, start, end, how, value[:4] + "…", hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest(), x), strict=True):
                    column.append(v)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["doc_id", "start", "end", "found_by", "shown", "sha256", "x"])


def scan(docs: DataFrame, findings: list[tuple] | None = None, cut: float = CUT, text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """One row per candidate: doc_id, start, end (code points), found_by, shown (four characters), sha256, score, secret.

    Whole texts are scanned; null and empty texts have no candidates, repeated documents give
    repeated rows, a null id or path is allowed.  The value itself is never returned.
    """
    model = train(docs.sparkSession, findings)
    path = F.col(path_col).cast("string") if path_col and path_col in docs.columns else F.lit("")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text"), path.alias("path"))
    found = rows.mapInArrow(_found, "doc_id long, start long, end long, found_by string, shown string, sha256 string, x array<double>")
    scored = model.transform(found.withColumn("features", array_to_vector("x")))
    score = F.get(vector_to_array("probability"), F.lit(1))
    return scored.select("doc_id", "start", "end", "found_by", "shown", "sha256", score.alias("score"), (score >= cut).alias("secret"))
