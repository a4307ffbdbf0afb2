"""Secret scan: candidates by pattern, false positives removed by a forest.

Candidates are runs of ``SHORTEST`` or more characters that tokens and keys are
made of, and every value of ``SHORTEST_ASSIGNED`` or more characters that is
assigned to a credential's name, whatever it is made of, anywhere in the whole
text. In NAME=value, name:value and ?name=value the candidate is the value
alone; a value goes to its closing quote, else to the next blank, comma,
semicolon or quote (in a query string also to & or #). Each is described by its length, its characters and the transitions between them, how much of it
the dictionary covers, its path and its neighbouring words; a random forest
trained from labelled findings gives the probability that it is a secret.

The dictionary is the ``DICTIONARY`` most frequent words of all documents
(counted in full, by partial counts per task). Labelled findings come as a
table (doc_id, start, secret); at most ``SAMPLE`` of them are used, half of them
of each kind, those with the smallest hashes. Without such a table ``labelled`` derives one from the
findings themselves: a value of 20 characters or more that is assigned to a
credential's name is a secret, and what has the form of an address, a number,
a date or an unassigned word is none; others stay unlabelled. The forest never sees that rule, and
it is not given the assigned-name test as one feature but its parts.

Defined results: null and empty texts have no findings; a null source is the
empty path; repeated rows give repeated findings; when labels of both kinds are
missing every finding keeps probability 1 (nothing is removed); empty tables
give empty results; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import table, written
from medallion.session import scratch_path

SHORTEST = 12
SHORTEST_ASSIGNED = 4
DICTIONARY = 5_000
SAMPLE = 20_000
TREES = 20
DEPTH = 6

# Names that credentials and that harmless values often have.
CREDENTIAL = ["token", "secret", "password", "passwd", "pwd", "key", "apikey", "api_key", "auth", "bearer",
              "credential", "credentials", "access", "private", "signature"]
HARMLESS = ["sha", "sha1", "sha256", "md5", "checksum", "digest", "commit", "hash", "uuid", "id", "example",
            "sample", "dummy", "test", "placeholder", "version", "isbn", "phone", "tel", "mail", "email"]

CANDIDATE = re.compile(r"[A-Za-z0-9_+/=.@:\-]{%d,}" % SHORTEST)
WORD = re.compile(r"[^\W\d_]+")
# Assignments: the name before a separator, the separator, and the value in
# quotes, in a query string, or else.
NAME = r"([A-Za-z_][\w.\-]*)['\"`]?\]?[ \t]*"
NAME_BEFORE = re.compile(NAME + "$")
SEPARATOR = re.compile(r"=>|[=:]+(?!//|[=:])")
SCHEME = r"(?:(?:bearer|basic|token)[ \t]+)?"
QUOTED = re.compile(r"[ \t]*(['\"`])" + SCHEME + r"((?:\\.|(?!\1)[^\\\n])+)\1", re.I)
IN_QUERY = re.compile(r"()([^\s'\"`<>,;&#]+)")
PLAIN = re.compile(r"[ \t]*" + SCHEME + r"['\"`(\[{]*()([^\s'\"`,;]+)", re.I)
ASSIGNED = re.compile(NAME + r"(?:=>|[=:]+)\s*['\"`(\[{]*" + SCHEME + "$", re.I)
INNER = re.compile(NAME + SEPARATOR.pattern)
FEATURES = ["length", "digits", "upper", "lower", "other", "transitions", "kinds", "distinct", "entropy", "digit_run",
            "hex", "dictionary", "pairs", "path_depth", "path_harmless", "quoted", "assigned", "credential_near", "harmless_near"]


def _credential(name: str) -> bool:
    return any(word in name.lower() for word in CREDENTIAL)


def _assigned(text: str) -> Iterator[tuple[int, str]]:
    """(start, value) of what is assigned to credentials' names."""
    end = 0
    for sep in SEPARATOR.finditer(text):
        low = max(end, sep.start() - 64)
        name = NAME_BEFORE.search(text[low : sep.start()])
        if sep.start() < end or not name or not _credential(name[1]):
            continue
        query = text[max(0, low + name.start() - 1) : low + name.start()] in ("?", "&")
        m = IN_QUERY.match(text, sep.end()) if query else QUOTED.match(text, sep.end()) or PLAIN.match(text, sep.end())
        inner = m and INNER.match(m[2])
        if not m or (inner and _credential(inner[1])):
            continue  # the value is itself an assignment, and comes with its own separator
        value = m[2] if m[1] else m[2].rstrip(".:)]}")
        if len(value) >= SHORTEST_ASSIGNED:
            yield m.start(2), value
            end = m.start(2) + len(value)


def _parts(run: str) -> Iterator[tuple[int, str]]:
    """(start, part): a run cut at = and : after a name; names without a digit
    are left out. Pairs of hex digits (addresses, fingerprints) are no names."""
    low = 0
    for sep in SEPARATOR.finditer(run):
        left = run[low : sep.start()]
        if sep.end() < len(run) and re.fullmatch(r"[A-Za-z_][\w.\-]*", left) and not re.fullmatch(r"[0-9a-fA-F]{1,4}", left):
            if any(c.isdigit() for c in left):
                yield low, left
            low = sep.end()
    yield low, run[low:]


def candidates(text: str | None) -> Iterator[tuple[int, str]]:
    """(start, value) of every candidate, in order."""
    text = text or ""
    assigned = list(_assigned(text))
    ends = [start + len(value) for start, value in assigned]
    found = list(assigned)
    for m in CANDIDATE.finditer(text):
        for low, part in _parts(m.group()):
            value = part.strip("=.:-/@")
            start = m.start() + low + (part.index(value) if value else 0)
            k = bisect_right(ends, start)  # the first assigned value that ends after it
            if len(value) >= SHORTEST and not (k < len(ends) and assigned[k][0] < start + len(value)):
                found.append((start, value))
    yield from sorted(found)


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def describe(text: str, start: int, value: str, path: str, words: frozenset, pairs: frozenset) -> list[float]:
    """The features of one candidate, in the order of ``FEATURES``."""
    n = len(value)
    kinds = [_kind(c) for c in value]
    shares = [kinds.count(k) / n for k in range(4)]
    counts = Counter(value)
    low = value.lower()
    parts = WORD.findall(low)
    letters = sum(map(len, parts))
    steps = [a + b for p in parts for a, b in zip(p, p[1:])]
    before, after = text[max(0, start - 48) : start], text[start + n : start + n + 24]
    around = " ".join(before.split()[-3:]) + " " + " ".join(after.split()[:2])
    around = (around + " " + re.sub(r"(?<=[a-z0-9])(?=[A-Z])|_", " ", around)).lower()  # names whole and in parts
    near = set(re.findall(r"[a-z_0-9]+", around))
    folders = [x for x in re.split(r"[/\\.]", path.lower()) if x]
    return [
        float(n), shares[0], shares[2], shares[1], shares[3],
        sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1), float(len(set(kinds))), len(counts) / n,
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        max(map(len, re.findall(r"[0-9]+", value)), default=0) / n, sum(c in "0123456789abcdef" for c in low) / n,
        sum(len(p) for p in parts if p in words) / letters if letters else 0.0,
        sum(s in pairs for s in steps) / len(steps) if steps else 0.0,
        float(len(folders)), float(any(h in f for f in folders for h in ("test", "example", "sample", "doc"))),
        float(before[-1:] in ("'", '"', "`") and after[:1] == before[-1:]),
        float(bool(ASSIGNED.search(before))),
        float(not near.isdisjoint(CREDENTIAL)), float(not near.isdisjoint(HARMLESS)),
    ]


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The most frequent words of three letters or more in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for text in batch.column("text"):
                seen.update((text.as_py() or "").lower().split())
                if len(seen) > 300_000:
                    yield flush()
        if seen:
            yield flush()

    counts = docs.select("text").mapInArrow(count, "word string, n long")
    plain = counts.select(F.regexp_replace("word", r"^\W+|\W+$", "").alias("word"), "n").where(F.col("word").rlike(r"^\p{L}{3,}$"))
    top = plain.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(size)
    return [r["word"] for r in top.select("word").collect()]


def findings(docs: DataFrame, words: list[str]) -> DataFrame:
    """(doc_id, start, length, form, assigned_name, feature): every candidate of
    every document; ``form`` is its plain shape, never its text."""
    known = frozenset(words)
    pairs = frozenset(w[i : i + 2] for w in words for i in range(len(w) - 1))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("path"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, path, text in zip(*(batch.column(c) for c in ("doc_id", "path", "text"))):
                doc_id, path, text = doc_id.as_py(), path.as_py(), text.as_py()
                for start, value in candidates(text):
                    rows.append((doc_id, start, len(value), form_of(value), assigned_name(text, start),
                                 describe(text, start, value, path, known, pairs)))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.float64())]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["doc_id", "start", "length", "form", "assigned_name", "feature"])

    return plain.mapInArrow(run, "doc_id long, start long, length long, form string, assigned_name string, feature array<double>")


def form_of(value: str) -> str:
    """address, number, date, word or other."""
    if re.fullmatch(r"[\w.+\-]+@[\w.\-]+", value):
        return "address"
    if re.fullmatch(r"[\d.:\-+/]+", value):
        return "date" if re.fullmatch(r"\d{4}-\d\d-\d\d.*", value) else "number"
    plain = all(x.islower() or x.isupper() or x.istitle() for x in WORD.findall(value))
    return "word" if plain and re.fullmatch(r"[^\d+=]+", value) else "other"


def assigned_name(text: str, start: int) -> str | None:
    """The name a value is assigned to, as in ``name = "value"``."""
    m = ASSIGNED.search(text[max(0, start - 96) : start])
    return m and m[1].lower()


def labelled(found: DataFrame) -> DataFrame:
    """Labels derived from the findings: (doc_id, start, secret)."""
    name = F.col("assigned_name")
    credential = F.lit(False)
    for word in CREDENTIAL:
        credential = credential | name.contains(word)
    plain = F.col("form").isin("address", "number", "date") | ((F.col("form") == "word") & name.isNull())
    secret = F.when(plain, 0).when(credential & (F.col("length") >= 20), 1)
    return found.select("doc_id", "start", secret.alias("secret")).where("secret IS NOT NULL")


def train(found: DataFrame, labels: DataFrame):
    """A random forest from labelled findings; None without both kinds."""
    from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    known = labels.where("doc_id IS NOT NULL AND start IS NOT NULL AND secret IS NOT NULL").groupBy("doc_id", "start").agg(
        F.max("secret").cast("double").alias("label"))
    rows = found.select("doc_id", "start", "feature").join(known, ["doc_id", "start"])
    first = [F.xxhash64("doc_id", "start"), F.col("doc_id"), F.col("start")]
    halves = [rows.where(F.col("label") == k).orderBy(*first).limit(SAMPLE // 2) for k in (0, 1)]
    rows = halves[0].union(halves[1]).repartition(8)
    rows = written(rows.select(array_to_vector("feature").alias("features"), "label"), "secret_sample")
    if rows.select("label").distinct().count() < 2:
        return None
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11).fit(rows)
    # read back from storage, the model is free of its training summary, which
    # holds the session and cannot be sent to tasks once observations were used
    path = scratch_path(found.sparkSession, "llm", "secret_model")
    model.write().save(path)
    return RandomForestClassificationModel.load(path)


def scan(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(doc_id, start, length, probability, secret): every candidate, and
    whether it remains as a secret."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    found = written(findings(docs, dictionary(docs)), "findings")
    model = train(found, labelled(found) if labels is None else labels)
    rows = found.select("doc_id", "start", "length", array_to_vector("feature").alias("features"))
    if model is None:
        scored = rows.withColumn("probability", F.lit(1.0))
    else:
        scored = model.transform(rows).withColumn("probability", vector_to_array("probability")[1])
    return scored.select("doc_id", "start", "length", "probability", (F.col("probability") >= 0.5).alias("secret"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
