"""URL filters: rules first, then a classifier over the words of host and path.

Hosts run words together (``cheappills``). A lexicon of words and how often texts hold them is a unigram model; the most
probable split of a host's labels under it is found by Viterbi's algorithm. The urls that a rule decides are the
examples from which multinomial naive Bayes learns what words of hosts and of paths say, and it judges the others.

Hosts are split, and hosts and paths scored, once per distinct host and path. The lexicon and the word scores are joined,
not broadcast, since both grow with the data.
"""

from functools import reduce
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazelake.llm.common import ascii_lower, only, sliced, staged

#: Host, path, verdict.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: Longest word of the lexicon, in characters.
LONGEST = 20
#: Added to every count of the classifier.
ALPHA = 1.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased in A-Z; then up to ``?`` or ``#``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as ``host`` + ``path``, and its verdict; null if none does.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for h, p, _ in ordered]
    name = F.coalesce(*(F.when(fit, F.lit(h + p)) for fit, (h, p, _) in zip(fits, ordered, strict=True)))
    verdict = F.coalesce(*(F.when(fit, F.lit(v)) for fit, (_, _, v) in zip(fits, ordered, strict=True)))
    return name, verdict


def learn_lexicon(texts: DataFrame, column: str) -> DataFrame:
    """``word, n``: how often the texts hold each lower-cased run of letters of at most ``LONGEST``."""
    words = F.explode(F.split(F.lower(F.col(f"`{column}`")), r"[^\p{L}]+"))
    return texts.select(words.alias("word")).where(F.length("word").between(1, LONGEST)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _labels(text: Column) -> Column:
    """Runs of letters and of digits."""
    return F.filter(F.split(text, r"[^\p{L}\p{N}]+|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})"), lambda x: x != "")


def _split(label: str, known: dict[tuple[int, int], float], unknown: float) -> list[str]:
    """Most probable words of ``label``; ``known`` has the log-probability of the words at (start, length)."""
    best = [(0.0, 0)] + [(float("-inf"), 0)] * len(label)
    for end in range(1, len(label) + 1):
        for start in range(max(0, end - LONGEST), end):
            size = end - start
            score = best[start][0] + known.get((start, size), unknown - size * log(10))
            if score > best[end][0]:
                best[end] = score, start
    words, end = [], len(label)
    while end:
        start = best[end][1]
        words.append(label[start:end])
        end = start
    return words[::-1]


def _splitter(unknown: float):
    def split(batches):
        for batch in sliced(batches, 1024):
            words = []
            for row in batch.to_pylist():
                known = {(x["start"], x["size"]): x["score"] for x in row["found"] or () if x["score"] is not None}
                words.append(_split(row["label"], known, unknown))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.list_(pa.string()))], names=["label", "words"]
            )

    return split


def segmented(labels: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``label, words`` of the distinct ``labels(label)``: numbers are ``#``, the rest is split by the lexicon.

    A stretch that is no word costs as much as a tenth of a single occurrence for each of its letters.
    """
    total = lexicon.agg(F.sum("n")).first()[0] or 1
    letters = labels.where(F.col("label").rlike(r"^\p{L}+$"))
    start = F.explode(F.sequence(F.lit(1), F.length("label"))).alias("start")
    size = F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("label") - F.col("start") + 1))).alias("size")
    parts = letters.select("label", start).select("label", "start", size)
    parts = parts.withColumn("word", F.substr("label", F.col("start"), F.col("size")))
    scored = parts.join(lexicon.select("word", F.ln(F.col("n") / F.lit(float(total))).alias("score")), "word")
    found = scored.groupBy("label").agg(
        F.collect_list(F.struct((F.col("start") - 1).alias("start"), "size", "score")).alias("found")
    )
    split = letters.join(found, "label", "left").mapInArrow(_splitter(-log(total)), "label string, words array<string>")
    numbers = labels.where(~F.col("label").rlike(r"^\p{L}+$")).select("label", F.array(F.lit("#")).alias("words"))
    return split.unionByName(numbers)


def _scores(parts: DataFrame, key: str, model: DataFrame) -> DataFrame:
    """Sum of the word scores of each ``key`` of ``parts(key, token)``; words that were never seen say nothing."""
    return parts.join(model, "token").groupBy(key).agg(F.sum("score").alias(f"{key}_score"))


def url_verdicts(pages: DataFrame, lexicon: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages(page_id, url, …)``.

    A null url, or one without ``://``, has an empty host and path, fits no rule, and is judged by how often the rules
    block. Scores at or below 0 allow. If the rules decide no url, or all alike, the classifier allows, or says
    what they say. Repeated rows and ids are judged each.
    """
    host, path = host_and_path(F.col("url"))
    urls = only(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = urls.withColumn("rule", name).withColumn("ruled", verdict)
    block, allow = ((F.col("ruled") == v).cast("long") for v in ("block", "allow"))

    def tallied(key: str) -> DataFrame:
        tally = (F.sum(F.coalesce(c, F.lit(0))).alias(n) for c, n in ((block, "block"), (allow, "allow")))
        return urls.groupBy(key).agg(*tally)

    hosts, paths = tallied("host"), tallied("path")
    labelled = hosts.select("host", "block", "allow", F.explode(_labels(F.col("host"))).alias("label"))
    words = staged(segmented(labelled.select("label").distinct(), lexicon), "host-words")
    host_tokens = labelled.join(words, "label").select(
        "host", "block", "allow", F.explode("words").alias("word")
    ).select("host", "block", "allow", F.concat(F.lit("host:"), F.col("word")).alias("token"))
    path_words = F.explode(_labels(F.lower(F.col("path"))))
    path_token = F.when(F.col("word").rlike(r"^\p{N}+$"), F.lit("#")).otherwise(F.col("word"))
    path_tokens = paths.select("path", "block", "allow", path_words.alias("word")).select(
        "path", "block", "allow", F.concat(F.lit("path:"), path_token).alias("token")
    )
    counts = staged(
        host_tokens.drop("host")
        .unionByName(path_tokens.drop("path"))
        .groupBy("token")
        .agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"))
        .where("block + allow > 0"),
        "url-tokens",
    )
    sums = counts.agg(F.sum("block").alias("b"), F.sum("allow").alias("a"), F.count(F.lit(1)).alias("v")).first()
    urls_of = hosts.agg(F.sum("block").alias("b"), F.sum("allow").alias("a")).first()
    n_block, n_allow = urls_of["b"] or 0, urls_of["a"] or 0
    prior = log((n_block + ALPHA) / (n_allow + ALPHA)) if n_block and n_allow else (1e9 if n_block else -1e9)
    bias = log(((sums["b"] or 0) + ALPHA * (sums["v"] or 1)) / ((sums["a"] or 0) + ALPHA * (sums["v"] or 1)))
    model = counts.select("token", (F.ln((F.col("block") + ALPHA) / (F.col("allow") + ALPHA)) - bias).alias("score"))
    judged = (
        urls.join(_scores(host_tokens.select("host", "token"), "host", model), "host", "left")
        .join(_scores(path_tokens.select("path", "token"), "path", model), "path", "left")
    )
    odds = reduce(lambda a, b: a + b, (F.coalesce(F.col(c), F.lit(0.0)) for c in ("host_score", "path_score"))) + prior
    verdict = F.coalesce("ruled", F.when(odds > 0, F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.round(odds, 6).alias("block_odds"))
