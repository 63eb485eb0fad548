"""Secret scans: pattern spans, and candidates judged by how many owners hold them.

Patterns with a name of their own (assignments, access keys, hex digests) are reported wherever
they stand. Besides them the scan takes every long mixed token as a candidate. The values of all
of them are hashed and counted over the whole corpus: in how many distinct repositories and owners
each occurs, in whatever form. A value that several owners hold is a copied example; one that a
single owner holds looks live. Candidates that look live are reported as well, and the named spans
are counted by the same verdict.

All of it is DataFrame built-ins. Positions come from cutting a text at the matches: the pieces
between them and the matches themselves add up to code point offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import Staging, as_row, let, out_of_row, scanned, shuffles_dropped

#: Kinds in the order in which spans that start together are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs shorter than asked for cannot hold a match of their own, so the bound is in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: What follows the name in an assignment, to measure its value.
ASSIGN_HEAD = r"""(?i)^(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
LEAST_VALUE = 6
BASE = ["assign", "access", "hex"]
LIVE = "live"

#: A candidate: a token of this alphabet and length with digits and letters of both cases.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
MIXED = r"^(?=(?:[^0-9]*[0-9]){3})(?=[^A-Z]*[A-Z])(?=[^a-z]*[a-z])"
#: Candidates of more distinct owners than this are examples.
MAX_OWNERS = 1

SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def _none() -> Column:
    return F.array().cast(SPANS)


def found_spans(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost non-overlapping matches as spans in code points, ends exclusive. The text is cut
    only where it has a match at all; offsets are running sums of lengths, so that a text with
    many matches costs little more than in proportion."""

    def spans_of(matches: Column) -> Column:
        pieces = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
        lengths = F.zip_with(
            pieces,
            matches,
            lambda piece, match: F.struct(F.length(piece).alias("gap"), F.length(match).alias("length"), match.alias("value")),
        )

        def placed(parts: Column) -> Column:
            ends = scanned(F.transform(parts, lambda p: p["gap"] + p["length"]), lambda x, y: x + y)
            return F.zip_with(
                parts,
                ends,
                lambda p, end: F.struct(
                    F.lit(kind).alias("kind"), (end - p["length"]).alias("start"), end.alias("end"), p["value"].alias("value")
                ),
            )

        return F.when(F.size(matches) > 0, let(lengths, placed)).otherwise(_none())

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans_of)


def outside(tokens: Column, spans: Column) -> Column:
    """The tokens, which do not overlap each other, that overlap no span.

    Starts of spans and ends of tokens are sorted together; a token is free if no span that
    starts before its end reaches beyond its start.
    """
    starts = F.transform(spans, lambda s: F.struct(s["start"].alias("key"), F.lit(1).alias("later"), s["end"].alias("reach"), F.lit(-1).alias("at")))
    ends = F.transform(tokens, lambda t, i: F.struct(t["end"].alias("key"), F.lit(0).alias("later"), F.lit(-1).alias("reach"), i.alias("at")))

    def free(events: Column) -> Column:
        reach = scanned(F.transform(events, lambda e: e["reach"]), F.greatest)
        known = F.zip_with(events, reach, lambda e, r: F.struct(e["at"].alias("at"), r.alias("reach")))
        kept = F.filter(known, lambda k: F.when(k["at"] >= 0, k["reach"] <= F.get(tokens, k["at"])["start"]).otherwise(F.lit(False)))
        return F.transform(kept, lambda k: F.get(tokens, k["at"]))

    return F.when(F.size(tokens) > 0, let(F.sort_array(F.concat(starts, ends)), free)).otherwise(_none())


def base_spans(text: Column) -> dict[str, Column]:
    assigned = F.filter(
        found_spans(text, ASSIGN, "assign"),
        lambda s: F.length(F.regexp_replace(s["value"], ASSIGN_HEAD, "")) >= LEAST_VALUE,
    )
    return {
        "assign": assigned,
        "access": found_spans(text, ACCESS, "access"),
        "hex": found_spans(text, HEX, "hex"),
    }


def _in_order(spans: Column, kinds: list[str]) -> Column:
    """Spans by start, then kind as listed."""
    place = F.array(*map(F.lit, kinds))
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.array_position(place, s["kind"]).alias("place"), s["end"].alias("end"), s["kind"].alias("kind")
        ),
    )
    return F.sort_array(keyed)


def rendered(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(
        F.transform(
            _in_order(spans, kinds),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def scan(docs: DataFrame, *, id_col: str, text_col: str, owner: Column, repository: Column) -> DataFrame:
    """doc_id, doc_key, owner, repository and the spans ``assign``, ``access``, ``hex``, ``candidates``.

    ``doc_key`` tells rows apart that share an id but not a text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        owner.cast("string").alias("owner"),
        repository.cast("string").alias("repository"),
    )
    found = narrow.select(
        "doc_id",
        F.xxhash64("doc_id", text).alias("doc_key"),
        "owner",
        "repository",
        *(spans.alias(kind) for kind, spans in base_spans(text).items()),
        F.filter(found_spans(text, CANDIDATE, LIVE), lambda s: s["value"].rlike(MIXED)).alias("tokens"),
    )
    free = let(F.col("tokens"), lambda tokens: outside(tokens, F.concat(*BASE)))
    return found.select(*(name for name in found.columns if name != "tokens"), free.alias("candidates"))


def own_value(span: Column) -> Column:
    """What a named span holds: of an assignment what is assigned, without the full stops that end
    a sentence; of others all."""
    return F.regexp_replace(F.regexp_replace(span["value"], ASSIGN_HEAD, ""), r"\.+$", "")


def held_values(named: Column) -> Column:
    """The values of named spans and, as an assigned value may have parts cut at full stops, the
    candidates inside them."""
    values = F.transform(named, own_value)
    inside = F.flatten(F.transform(values, lambda v: F.regexp_extract_all(v, F.lit(CANDIDATE), F.lit(0))))
    return F.concat(values, F.filter(inside, lambda v: v.rlike(MIXED)))


def ownership(found: DataFrame) -> DataFrame:
    """Per hash of a value, of named spans and candidates alike: in how many distinct repositories
    and owners it occurs.

    Repeats are dropped before and after the shuffle by (hash, owner, repository), so that a
    widely copied value reaches its counting task once per repository.
    """
    held = found.select(
        F.explode(F.concat(held_values(F.concat(*BASE)), F.col("candidates.value"))).alias("value"), "owner", "repository"
    ).select(F.sha2("value", 256).alias("hash"), "owner", "repository")
    return (
        held.distinct()
        .groupBy("hash", "owner")
        .agg(F.count("*").alias("of_owner"))
        .groupBy("hash")
        .agg(F.sum("of_owner").alias("repositories"), F.count("*").alias("owners"))
    )


def live_spans(found: DataFrame, *, max_owners: int = MAX_OWNERS, max_repositories: int | None = None) -> DataFrame:
    """Per (doc_id, doc_key) with spans: the candidates that ``max_owners`` owners and, where given,
    ``max_repositories`` repositories at most hold as ``live``, and the number of the others as
    ``n_examples``; the numbers of named spans of either kind as ``n_base_live`` and
    ``n_base_examples``; the most owners and repositories of one value."""
    every = F.concat(
        F.transform(F.concat(*BASE), lambda s: F.struct(s.alias("span"), own_value(s).alias("value"))),
        F.transform("candidates", lambda s: F.struct(s.alias("span"), s["value"].alias("value"))),
    )
    some = F.size(F.concat(*BASE, "candidates")) > 0
    per_document = found.where(some).dropDuplicates(["doc_id", "doc_key"])
    spans = per_document.select("doc_id", "doc_key", F.explode(every).alias("e")).select(
        "doc_id", "doc_key", F.col("e.span").alias("s"), F.sha2("e.value", 256).alias("hash")
    )
    own, bare = F.col("owners") <= max_owners, F.col("s.kind") == LIVE
    if max_repositories is not None:
        own &= F.col("repositories") <= max_repositories
    return (
        spans.join(ownership(found), "hash")
        .groupBy("doc_id", "doc_key")
        .agg(
            F.collect_list(F.when(own & bare, F.col("s"))).alias("live"),
            F.count_if(~own & bare).alias("n_examples"),
            F.count_if(own & ~bare).alias("n_base_live"),
            F.count_if(~own & ~bare).alias("n_base_examples"),
            F.max("owners").alias("n_owners"),
            F.max("repositories").alias("n_repositories"),
        )
    )


def secret_scan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner: Column | None = None,
    repository: Column | None = None,
    max_owners: int = MAX_OWNERS,
    max_repositories: int | None = None,
) -> DataFrame:
    """One row per document: doc_id, spans (array of kind, start, end, value), n_assign,
    n_access, n_hex, n_live, n_examples, n_base_live, n_base_examples, n_owners, n_repositories
    (long). The named spans are counted by the verdict on their values; the last two are the most
    owners and repositories that any of the document's values has, 0 without any.

    The owner is the source of a document and a repository one language of a source, unless
    given. Spans are in code points, ends exclusive.

    Defined cases: a NULL text is an empty one and has no spans; a NULL owner or repository
    counts as one more; repeated rows each get a row with the same spans and count once for
    ownership; texts are found whole; an empty table gives an empty result; other columns are
    ignored.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", F.col("source"), F.col("lang")) if repository is None else repository
    spark = docs.sparkSession
    with shuffles_dropped(spark):
        staging = Staging(spark, "secrets")
        found = staging.keep(
            scan(docs, id_col=id_col, text_col=text_col, owner=owner, repository=repository)
        )
        live = staging.keep(live_spans(found, max_owners=max_owners, max_repositories=max_repositories))
    joined = found.alias("d").join(
        live.alias("l"),
        F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("d.doc_key") == F.col("l.doc_key")),
        "left",
    )
    live_found = F.coalesce("l.live", _none())
    return joined.select(
        "d.doc_id",
        F.concat(*BASE, live_found).alias("spans"),
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in BASE),
        F.size(live_found).cast("long").alias("n_live"),
        *(F.coalesce(f"l.{n}", F.lit(0)).cast("long").alias(n) for n in ("n_examples", "n_base_live", "n_base_examples", "n_owners", "n_repositories")),
    )


#: Text as four bytes a code point, so that a slice is found without reading what is before it.
#: A byte order mark in front of each slice keeps one of the text from being taken for that.
_WIDE, _MARK = "UTF-32", "0000FEFF"


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``[kind]``; of spans that overlap, all of what they
    cover goes, under the kind that starts first."""

    def cut(wide: Column, start: Column, end: Column) -> Column:
        return F.decode(F.concat(F.unhex(F.lit(_MARK)), F.substring(wide, start * 4 + 1, (end - start) * 4)), _WIDE)

    def joined(wide: Column, ordered: Column, reach: Column) -> Column:
        before = F.transform(
            ordered,
            lambda s, i: F.struct(
                F.when(i > 0, F.get(reach, i - 1)).otherwise(F.lit(0)).alias("at"), s["start"].alias("start"), s["kind"].alias("kind")
            ),
        )
        heads = F.filter(before, lambda s: s["start"] >= s["at"])
        parts = F.transform(heads, lambda s: F.concat(cut(wide, s["at"], s["start"]), F.lit("["), s["kind"], F.lit("]")))
        last = F.element_at(reach, -1)
        return F.concat(F.array_join(parts, ""), cut(wide, last, F.octet_length(wide).cast("int")))

    def with_reach(ordered: Column) -> Column:
        reach = scanned(F.transform(ordered, lambda s: s["end"]), F.greatest)
        return let(F.encode(text, _WIDE), lambda wide: let(reach, lambda r: joined(wide, ordered, r)))

    return F.when(F.size(spans) > 0, let(_in_order(spans, [*BASE, LIVE]), with_reach)).otherwise(text)


def without_secrets(docs: DataFrame, **options) -> DataFrame:
    """The documents, all columns, with their secrets redacted and ``n_chars`` renewed where it
    exists. The verdict on a text is carried by (doc_id, text), so repeated rows change alike.

    Defined cases: a NULL text stays NULL; a NULL source counts as one more owner; rows without
    an id are redacted like others; texts are read whole; ties do not occur, as every span goes;
    an empty table gives an empty result; all other columns stay as they are, whatever their name.
    """
    spark = docs.sparkSession
    with shuffles_dropped(spark):
        staging = Staging(spark, "redact")
        found = staging.keep(
            scan(
                docs, id_col="doc_id", text_col="text", owner=F.col("source"),
                repository=F.concat_ws("/", F.col("source"), F.col("lang")),
            )
        )
        live = staging.keep(live_spans(found, **options))
    spans = (
        found.alias("d")
        .join(
            live.alias("l"),
            F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("d.doc_key") == F.col("l.doc_key")),
            "left",
        )
        .select(
            F.col("d.doc_id").alias("of_id"),
            F.col("d.doc_key").alias("of_key"),
            F.concat(*BASE, F.coalesce("l.live", _none())).alias("spans"),
        )
        .where(F.size("spans") > 0)
        .dropDuplicates(["of_id", "of_key"])
    )
    doc_id = F.col("doc_id").cast("long")
    keyed = docs.select(as_row(docs), doc_id.alias("id"), F.xxhash64(doc_id, F.coalesce(F.col("text"), F.lit(""))).alias("key"))
    joined = keyed.join(spans, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key")), "left")
    hit, text = F.col("spans").isNotNull(), F.col("row")["text"]
    changed = joined.select("row", "spans", F.when(hit, redacted(text, F.col("spans"))).otherwise(text).alias("new"))
    renewed = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        renewed["n_chars"] = F.when(hit, F.length("new").cast(kind)).otherwise(F.col("row")["n_chars"])
    return changed.select(*out_of_row(docs.columns, renewed))
