"""Connected components, and links among the members of inverted lists without all pairs of a list."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from billrisk.llm.common import free, scratch, tidy, written


def _cut(df: DataFrame) -> DataFrame:
    """A written table: a checkpoint keeps the optimizer's constraints, which multiply when columns are renamed each round."""
    return written(df, "links")


def components(links: DataFrame) -> DataFrame:
    """(id, comp) of every id in ``links`` (a, b); comp is the smallest id that links reach.

    Each round lets every id take the smallest id among its neighbours and
    itself, and then that one's choice; links between ids that are one by then
    disappear, and the others go on as links between what is left.  So rounds
    shrink quickly, and the choices of all rounds are put together at the end,
    the small ones first.  Joins read tables that are already written and hold
    no other step, so adaptive execution can split a hot id; minima combine
    before they are shuffled.  Tables are deleted when the next ones stand.
    """
    with scratch(links.sparkSession) as scope:
        edges = _cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        choices: list[DataFrame] = []
        while not choices or not edges.isEmpty():
            both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            near = _cut(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("comp")))
            up = near.select(F.col("id").alias("up"), F.col("comp").alias("root"))
            choices.append(_cut(near.join(up, near.comp == up.up).select("id", F.col("root").alias("comp"))))
            x, y = (choices[-1].select(F.col("id").alias(end), F.col("comp").alias("c" + end)) for end in "ab")
            left = _cut(edges.join(x, "a").join(y, "b").where("ca <> cb").select(
                F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct())
            free(near, edges)
            edges = left
        found = choices.pop()
        while choices:
            first = choices.pop()
            later = found.select(F.col("id").alias("up"), F.col("comp").alias("root"))
            joined = _cut(first.join(later, first.comp == later.up, "left").select("id", F.coalesce("root", "comp").alias("comp")))
            free(first, found)
            found = joined
        return scope.keep(found)


def verified(verify: Callable[[DataFrame], DataFrame], pairs: DataFrame) -> DataFrame:
    """The links among ``pairs``, written; what ``verify`` wrote on the way is deleted, and so are the pairs."""
    with scratch(pairs.sparkSession) as scope:
        out = scope.keep(_cut(verify(pairs)))
    free(pairs)
    tidy(pairs.sparkSession)
    return out


Near = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def _side(lists: DataFrame, name: str, extra: list[str]) -> DataFrame:
    return lists.select("key", F.col("id").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in extra))


def link_lists(lists: DataFrame, verify: Callable[[DataFrame], DataFrame], near: Near | None = None,
               short: int = 64, star_rounds: int = 8, least: Callable[[Column, Column], Column] | None = None,
               broadcast_rows: int = 500_000, meet: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Verified links (a, b, ...) that join everything which any list should join.

    ``lists`` (key, id, ...), without repeated rows: members of one key are
    candidates of each other.  ``near`` gets two functions from the name of a
    further column to that column of either member, and rules out pairs
    cheaply; ``verify`` takes pairs (a < b) and returns those that are links.
    ``least``, from the sizes ``n`` of both, says in how many lists a pair has
    to occur to be a link; a pair counts as occurring in every long list.
    In lists of up to ``short`` members every pair is looked at, which is at
    most ``short`` comparisons a row; longer lists follow by stars.  What stars
    leave open is joined pair by pair, unless ``meet`` takes the members (key,
    id, ..., comp, all, rest, aside) of those lists and returns the pairs of
    different components that it cannot rule out, each with a member aside.
    ``all`` members has a list, of which ``rest`` are aside, that is, not in
    its largest component.  The result need not hold every link, but two members of a list with a link are always
    in one component of the result.
    """
    extra = [c for c in lists.columns if c not in ("key", "id")]
    kept = lists.where("key is not null and id is not null")
    counts = kept.groupBy("key").agg(F.count("*").cast("int").alias("m")).where("m > 1")
    shared = written(kept.join(counts, "key"), "lists")
    few = shared.where(F.col("m") <= short)
    pairs = _side(few, "x", extra).join(_side(few, "y", extra), "key").where("x < y")
    if near is not None:
        pairs = pairs.where(near(lambda c: F.col("x_" + c), lambda c: F.col("y_" + c)))
    if least is None:
        pairs = pairs.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    else:  # how many of its lists are long is known for each member
        busy = shared.where(F.col("m") > short).groupBy("id").agg(F.count("*").alias("long"))
        counted = pairs.groupBy(F.col("x").alias("a"), F.col("y").alias("b")).agg(
            F.count("*").alias("c"), least(F.max("x_n"), F.max("y_n")).alias("least"))
        busy = written(busy, "busy")
        busy = F.broadcast(busy) if busy.count() <= broadcast_rows else busy
        pairs = counted.join(busy.select(F.col("id").alias("a"), "long"), "a", "left").where(
            F.col("c") + F.coalesce("long", F.lit(0)) >= F.col("least")).select("a", "b")
    links = verified(verify, _cut(pairs))
    many = shared.where(F.col("m") > short).drop("m")
    if not many.isEmpty():
        links = _star_links(many, extra, links, verify, near, short, star_rounds, meet)
    free(shared)
    return links


def _star_links(lists: DataFrame, extra: list[str], links: DataFrame, verify: Callable[[DataFrame], DataFrame],
                near: Near | None, short: int, star_rounds: int, meet: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """``links`` and those of long lists.

    While the pairs still open are more than ``short`` a row and become fewer,
    members are held against one pivot of their list (a "star", linear in its
    size); then every pair of members that are in different components by now
    is verified.
    """
    before, budget = None, max(3, short) * lists.count()
    for turn in range(star_rounds + 1):
        found = components(links)
        comp = found.withColumnRenamed("id", "of")
        labelled = _cut(lists.join(comp, lists.id == comp.of, "left")
                               .select("key", "id", *extra, F.coalesce("comp", "id").alias("comp")))
        free(found)
        parts = labelled.groupBy("key", "comp").agg(F.count("*").alias("m"))
        lead = parts.groupBy("key").agg(
            F.max(F.struct("m", "comp")).alias("top"), F.sum("m").alias("all"), F.count("*").alias("parts"))
        lead = _cut(lead.where("parts > 1").select(
            "key", "all", F.col("top.comp").alias("top"), (F.col("all") - F.col("top.m")).alias("rest")))
        open_pairs = lead.agg(F.sum(F.col("rest") * F.col("all"))).first()[0]
        if not open_pairs:
            free(labelled, lead)
            break
        last = turn == star_rounds or open_pairs <= budget or (before is not None and open_pairs > 0.7 * before)
        before = open_pairs
        x, y = (_side(labelled, side, [*extra, "comp"]) for side in "xy")
        if last and meet is not None:
            spare = _cut(labelled.join(lead, "key").select("key", "id", *extra, "comp", "all", "rest", (F.col("comp") != F.col("top")).alias("aside")))
            pairs = meet(spare)
        elif last:
            aside = _cut(x.join(lead.select("key", "top"), "key").where("x_comp <> top").drop("top"))
            pairs = aside.join(y, "key")
            spare = aside
        else:
            # a pivot that differs from turn to turn, so that some turn takes it from a large component
            mark = F.xxhash64("id", F.lit(turn)).alias("mark")
            pivot = labelled.join(lead.select("key"), "key", "left_semi").groupBy("key").agg(
                F.min(F.struct(mark, "id", *extra, "comp")).alias("p"))
            spare = _cut(_side(pivot.select("key", "p.*"), "y", [*extra, "comp"]))
            pairs = x.join(spare, "key")
        if not last or meet is None:
            pairs = pairs.where("x_comp <> y_comp")
            if near is not None:
                pairs = pairs.where(near(lambda c: F.col("x_" + c), lambda c: F.col("y_" + c)))
            pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        pairs = _cut(pairs.distinct())
        free(labelled, lead, spare)
        more = verified(verify, pairs)
        both = _cut(links.union(more))
        free(links, more)
        links = both
        if last:
            break
    return links
