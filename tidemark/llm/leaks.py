"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Patterns propose candidate values in every whole text.  A candidate's value is
hashed, and for each hash the corpus is asked how many distinct repositories and
distinct owners hold it.  A widely copied example is a value that many owners share, or
that two or more have in at least half of all their repositories.  Where a table has two
or three owners, "many" is all of them and as many repositories.  One that stays with a
single owner and looks random is a live credential, however often that owner copies it:
both rules count owners, or compare with the owners' own repositories, so they don't
change with the size of the corpus.

Spark has no function that gives the places of regular-expression matches, so
they are rebuilt exactly: ``split`` gives the text between the matches, and a running
sum of lengths (in code points), a window over each text's matches, gives each start.

Scale: texts are scanned once, inside the tasks that read them, and only the
candidates are staged and shuffled.  Distinct counts use Spark's two-level
aggregation with map-side combine, so an example that a third of all documents
copy is merged before the shuffle; the join of hashes to candidates is on the
few candidate rows and is skew-split by AQE.

Defined results: a null or empty text has no secrets; null repositories and
owners count as one unnamed each; repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage, text_or_empty

BASE = ("assign", "access", "hex")
# Each pattern, the group that holds the value, and the least length of that group.
# A run that is too short has no longer run inside, so for access and hex the
# length is part of the pattern; an assignment that is too short is dropped whole.
PATTERNS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
    # added kinds
    "github": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    "jwt": (r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 34),
    "private_key": (r"-----BEGIN (?:[A-Z]+ ){0,2}PRIVATE KEY-----", 0, 27),
}
#: A value that so many owners hold, or that two or more hold in this share of all their repositories,
#: or one whose characters hardly vary, is an example.
EXAMPLE_OWNERS = 4
EXAMPLE_SHARE = 0.5
MIN_DISTINCT_CHARS = 5
MARK = "[SECRET]"


def gaps_and_matches(text: Column, pattern: str, group: int) -> Column:
    """Array of (gap, size, value) of the pattern's matches in their order: the code points since the match before, its own, and the group."""
    p = F.lit(pattern)
    whole = F.regexp_extract_all(text, p, F.lit(0))
    value = F.regexp_extract_all(text, p, F.lit(group)) if group else whole
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("before"), whole.alias("whole"), value.alias("value"))
    # the last part has text only
    found = F.transform(
        F.filter(parts, lambda x: x["whole"].isNotNull()),
        lambda x: F.struct(F.length(x["before"]).cast("long").alias("gap"), F.length(x["whole"]).cast("long").alias("size"), x["value"].alias("value")),
    )
    return F.when(F.size(whole) > 0, found)


def candidates(docs: DataFrame, repo: str, owner: str) -> DataFrame:
    """One thin row for each document: ids, the text's hash and its matches by kind (null: none)."""
    base = docs.select(F.col(repo).alias("repo"), F.col(owner).alias("owner"), text_or_empty().alias("text"))
    base = base.withColumn("text_key", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    kinds = [gaps_and_matches(F.col("text"), pattern, group).alias(kind) for kind, (pattern, group, _) in PATTERNS.items()]
    return base.select("row", "repo", "owner", "text_key", *kinds)


def spans(hits: DataFrame) -> DataFrame:
    """A row for each candidate value: its place by a running sum over the gaps and sizes of the text's matches of its kind."""
    specs = [(rank, kind, least) for rank, (kind, (_, _, least)) in enumerate(PATTERNS.items())]
    kinds = F.array(*[F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), F.lit(least).alias("least"), F.col(kind).alias("parts")) for rank, kind, least in specs])
    by_kind = hits.select("row", "repo", "owner", F.explode(kinds).alias("k")).where(F.col("k.parts").isNotNull())
    each = by_kind.select("row", "repo", "owner", "k.rank", "k.kind", "k.least", F.posexplode("k.parts").alias("at", "part"))
    so_far = Window.partitionBy("row", "rank").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("part.gap") + F.col("part.size")).over(so_far)
    placed = each.withColumn("end", end).where(F.length("part.value") >= F.col("least"))
    return placed.select(
        "row", "repo", "owner", (F.col("end") - F.col("part.size")).alias("start"), "rank", "end", "kind",
        F.sha2(F.rtrim(F.col("part.value"), F.lit(".")).cast("binary"), 256).alias("hash"),  # a full stop may end the sentence
        F.size(F.array_distinct(F.split("part.value", ""))).alias("letters"),
    )


def scan_secrets(docs: DataFrame, repo: str = "doc_id", owner: str = "source", example_owners: int = EXAMPLE_OWNERS, example_share: float = EXAMPLE_SHARE) -> DataFrame:
    """For every document: ``repo``, ``owner``, ``text_key`` and ``secrets``, an array by start of
    (start, rank, end, kind, hash, letters, repos, owners, live).  Private-key headers are live always."""
    rows = stage(candidates(docs, repo, owner), "candidates")
    some = F.coalesce(*[F.col(k) for k in PATTERNS]).isNotNull()
    each = spans(rows.where(some)).withColumn("repo", F.coalesce(F.col("repo").cast("string"), F.lit(""))).withColumn("owner", F.coalesce(F.col("owner").cast("string"), F.lit("")))
    # the documents of every owner, with and without candidates, and one row for the whole table
    owned = rows.groupBy(F.coalesce(F.col("owner").cast("string"), F.lit("")).alias("owner")).agg(F.countDistinct(F.coalesce(F.col("repo").cast("string"), F.lit(""))).alias("owner_repos"))
    every = owned.agg(F.count("*").alias("all_owners"))
    by_owner = each.groupBy("hash", "owner").agg(F.countDistinct("repo").alias("held")).join(owned, "owner")
    by_hash = (
        by_owner.groupBy("hash")
        .agg(F.count("*").alias("owners"), F.sum("held").alias("held"), F.sum("owner_repos").alias("owner_repos"))
        .join(each.groupBy("hash").agg(F.countDistinct("repo").alias("repos")), "hash")
    )
    several = F.col("owners") >= 2
    by_all = several & (F.col("owners") == F.col("all_owners")) & (F.col("repos") >= example_owners)
    by_share = several & (F.col("held") >= example_share * F.col("owner_repos"))
    example = (F.col("owners") >= example_owners) | by_all | by_share
    live = (~example & (F.col("letters") >= MIN_DISTINCT_CHARS)) | (F.col("kind") == "private_key")
    judged = (
        each.join(by_hash.crossJoin(F.broadcast(every)), "hash")
        .groupBy(F.col("row").alias("found_row"))
        .agg(F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind", "hash", "letters", "repos", "owners", live.alias("live")))).alias("secrets"))
    )
    none = F.lit([]).cast(judged.schema["secrets"].dataType)
    with_hits = rows.where(some).select("row", "repo", "owner", "text_key").join(judged, F.col("row") == F.col("found_row"), "left")
    without = rows.where(~some).select("repo", "owner", "text_key", none.alias("secrets"))
    return with_hits.select("repo", "owner", "text_key", F.coalesce("secrets", none).alias("secrets")).unionByName(without)


def digest(scanned: DataFrame) -> DataFrame:
    label = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    of_kind = lambda k: lambda s: s["kind"] == k
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE))
    return scanned.select(
        F.col("repo").alias("doc_id"),
        *[F.size(F.filter("secrets", of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.array_join(F.transform(base, label), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("secrets", label), ",").alias("spans"),
        F.size(F.filter("secrets", lambda s: s["live"])).cast("long").alias("n_live"),
    )


def redact(docs: DataFrame, repo: str = "doc_id", owner: str = "source", example_owners: int = EXAMPLE_OWNERS, example_share: float = EXAMPLE_SHARE) -> DataFrame:
    """``docs`` with each live credential replaced by a mark; overlapping spans are replaced as one.

    Only documents with a live credential are changed; ``n_chars`` follows the
    text where the column is there.
    """
    scanned = scan_secrets(docs, repo, owner, example_owners, example_share)
    live = (
        scanned.select("repo", "owner", "text_key", F.filter("secrets", lambda s: s["live"]).alias("spans"))
        .where(F.size("spans") > 0)
        .dropDuplicates(["repo", "owner", "text_key"])
    )
    # spans that begin inside earlier ones join them
    each = live.select("repo", "owner", "text_key", F.posexplode("spans").alias("at", "s")).select("repo", "owner", "text_key", "at", "s.start", "s.end")
    text_keys = ["repo", "owner", "text_key"]
    before = Window.partitionBy(*text_keys).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*text_keys).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new = F.coalesce(F.col("start") >= F.max("end").over(before), F.lit(True))
    joined = each.withColumn("new", new.cast("int")).withColumn("part", F.sum("new").over(upto)).groupBy(*text_keys, "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    merged = stage(joined.groupBy(*text_keys).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")), "spans")
    found = merged.select(F.col("repo").alias("secret_r_"), F.col("owner").alias("secret_o_"), F.col("text_key").alias("secret_k_"), F.col("spans").alias("secret_spans_"))
    same = F.col(repo).eqNullSafe(F.col("secret_r_")) & F.col(owner).eqNullSafe(F.col("secret_o_")) & (F.xxhash64(text_or_empty()) == F.col("secret_k_"))
    out = docs.join(found, same, "left")
    text = F.when(F.col("secret_spans_").isNull(), F.col("text")).otherwise(_cut(F.col("text"), F.col("secret_spans_")))
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("secret_spans_").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def _cut(text: Column, gone: Column) -> Column:
    """The text with a mark in place of each of the ordered, disjoint spans ``gone``.

    A piece of a string is found by counting from its start, so the time is (spans + 1) x length of the text.
    """
    first = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(gone, i - 1)["end"])
    pieces = F.transform(gone, lambda s, i: F.substring(text, (first(i) + 1).cast("int"), (s["start"] - first(i)).cast("int")))
    rest = F.substring(text, (F.element_at(gone, -1)["end"] + 1).cast("int"), F.lit(2147483647))
    return F.concat(F.array_join(pieces, MARK), F.lit(MARK), rest)
