"""Secret scan with corpus-wide ownership (operator 2), in DataFrame functions only.

Patterns give candidates with their places.  Their hashes are counted over the
whole corpus by distinct owner, and by distinct repository where the table
names one: a value that many owners hold is a copied example, one that a
single owner holds is live-looking, however many documents repeat it.
Strong-looking tokens of no named kind become spans only where they are
live-looking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import table, written

ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: Kind, pattern, shortest match.  Fixed values; the order is that of the spans.
KINDS = [("assign", ASSIGN, 0), ("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24)]
#: Tokens of no named kind: long, with small and capital letters and digits.
TOKEN = r"[A-Za-z0-9+/_-]{24,}"
MIN_VALUE = 6
#: A value of at most so many owners, and of so many repositories where a column names them, looks live.
MAX_OWNERS, MAX_REPOS = 1, 3
#: Matches of one block.
BLOCK = 128
FOUND = "array<struct<start:int,kind:int,end:int,hash:string>>"


def once(value: Column, f) -> Column:
    """``f(value)`` with ``value`` worked out once, though ``f`` uses it in several places or in lambdas."""
    return F.element_at(F.transform(F.array(value), f), 1)


def blocks(items: Column) -> Column:
    """An array cut into arrays of ``BLOCK`` items; it is evaluated once."""
    def cut(x):
        return F.when(F.size(x) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int")),
                                                 lambda k: F.slice(x, k * BLOCK + 1, BLOCK)))

    return F.coalesce(once(items, cut), F.array())


def places(text: Column, kind: int, pattern: str, keep, value, probe: str | None = None) -> Column:
    """Array of (start, kind, end, hash of the value) of the pattern's matches, left to right.

    Splitting at the pattern gives the texts between the matches; running
    lengths of both, in code points, are the places.  They run inside blocks of
    matches, which then move to where they begin: the array of one block is
    copied at a match, never that of the whole text.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.filter(F.zip_with(matches, F.split(text, pattern, -1), lambda m, g: F.struct(m.alias("m"), g.alias("g"))),
                     lambda x: x["m"].isNotNull())

    def step(acc, x):
        start = acc["at"] + F.length(x["g"])
        end = start + F.length(x["m"])
        here = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
                                F.sha2(value(x["m"]), 256).alias("hash")))
        return F.struct(end.alias("at"), F.when(keep(x["m"]), F.concat(acc["out"], here)).otherwise(acc["out"]).alias("out"))

    empty = F.array().cast(FOUND)

    def move(acc, b):
        here = F.transform(b["out"], lambda f: F.struct((f["start"] + acc["at"]).alias("start"), f["kind"].alias("kind"),
                                                        (f["end"] + acc["at"]).alias("end"), f["hash"].alias("hash")))
        return F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["out"], F.array(here)).alias("out"))

    inside = F.transform(blocks(pairs), lambda b: F.aggregate(b, F.struct(F.lit(0).alias("at"), empty.alias("out")), step))
    found = F.flatten(F.aggregate(inside, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{FOUND}>").alias("out")), move,
                                  lambda acc: acc["out"]))
    return F.when(text.rlike(probe or pattern), found).otherwise(empty)


def candidates(text: Column) -> Column:
    """All candidates of a text, base kinds first; tokens only where no base span touches them."""
    def secret(m):
        return F.regexp_extract(m, ASSIGN, 2)

    base = F.concat(
        places(text, 0, ASSIGN, lambda m: F.length(secret(m)) >= MIN_VALUE, secret),
        places(text, 1, r"AKIA[A-Z0-9]{16,}", lambda m: F.lit(True), lambda m: m),
        places(text, 2, r"[0-9a-f]{24,}", lambda m: F.lit(True), lambda m: m))
    tokens = places(text, len(KINDS), TOKEN, lambda m: m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]"), lambda m: m)
    return F.struct(base.alias("base"), tokens.alias("tokens"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source",
         repo: str | None = None) -> DataFrame:
    """A written row per document: rid, doc_id, owner, repo, copy, found.

    Without a repository column ``repo`` is null.  ``copy`` names the text.
    A null text is empty; null owners and repositories count as one each.
    """
    both = candidates(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
                       (F.coalesce(F.col(repo).cast("string"), F.lit("")) if repo else F.lit(None).cast("string")).alias("repo"),
                       F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("copy"), both.alias("c"))
    # a token meets the bounds of a block of base spans first, and its spans only where it lies within them
    near = F.transform(blocks(F.col("c.base")), lambda b: F.struct(
        F.array_min(F.transform(b, lambda x: x["start"])).alias("low"), F.array_max(F.transform(b, lambda x: x["end"])).alias("high"),
        b.alias("spans")))
    free = once(near, lambda near: F.filter("c.tokens", lambda t: ~F.exists(near, lambda n: (
        n["low"] < t["end"]) & (t["start"] < n["high"]) & F.exists(
            n["spans"], lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))))
    return written(rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "owner", "repo", "copy",
                               F.concat("c.base", free).alias("found")), "secrets")


def ownership(rows: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos, live) of every candidate value.

    Owners are counted as they are.  Copies of one text stand in one
    repository, the first by name; without a repository column n_repos is the
    number of different texts and does not decide.  Distinct pairs are made
    first, so a value that a third of all documents hold is spread by its
    holders.
    """
    each = rows.select("owner", "repo", "copy", F.explode("found.hash").alias("hash"))
    owners = each.groupBy("hash").agg(F.countDistinct("owner").alias("n_owners"))
    places = (each.groupBy("hash", "copy").agg(F.min("repo").alias("repo"))
              .groupBy("hash", F.coalesce("repo", F.col("copy").cast("string")).alias("place"))
              .agg(F.max(F.col("repo").isNotNull()).alias("named"))
              .groupBy("hash").agg(F.count("*").alias("n_repos"), F.max("named").alias("named")))
    few = ~F.col("named") | (F.col("n_repos") <= MAX_REPOS)
    return written(owners.join(places, "hash").select("hash", "n_owners", "n_repos",
                                                      ((F.col("n_owners") <= MAX_OWNERS) & few).alias("live")), "secret-owners")


def judged(rows: DataFrame) -> DataFrame:
    """A row per candidate: rid, doc_id, kind, start, end, hash, n_owners, n_repos, live."""
    each = rows.select("rid", "doc_id", F.explode("found").alias("f")).select("rid", "doc_id", "f.*")
    return each.join(ownership(rows), "hash")


def spans_text(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k, _, _ in KINDS], F.lit("token"))
    one = F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def report(rows: DataFrame) -> DataFrame:
    """A row per document: counts and spans of the base kinds, and all spans with the live tokens."""
    verdicts = judged(rows).groupBy("rid").agg(
        F.collect_list(F.when((F.col("kind") == len(KINDS)) & F.col("live"), F.struct("start", "kind", "end"))).alias("added"),
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_copied"))
    all_ = rows.join(verdicts, "rid", "left")
    base = F.transform(F.filter("found", lambda f: f["kind"] < len(KINDS)),
                       lambda f: F.struct(f["start"].alias("start"), f["kind"].alias("kind"), f["end"].alias("end")))

    def n(kind):
        return F.size(F.filter("found", lambda f: f["kind"] == kind)).cast("long")

    added = F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    return all_.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                       F.sha2(spans_text(base), 256).alias("base_sha256"),
                       spans_text(F.concat(base, added)).alias("spans"),
                       F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"))


def op2(spark, sf_dir: str) -> DataFrame:
    return report(scan(table(spark, sf_dir, "documents")))
