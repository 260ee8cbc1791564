"""Writes as rewrites: upserts, patches, guards, merges and assertions, DataFrame to DataFrame.

Plain Parquet takes no MERGE or UPDATE, so each operator returns the new state of its table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def insert_missing(base: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that the base lacks (NOT EXISTS), added; columns that rows lack are null."""
    new = rows.join(base.select(*keys), keys, "left_anti")
    return base.unionByName(new.select(*[c for c in base.columns if c in rows.columns]), allowMissingColumns=True)


def dispositions(incoming: DataFrame, base: DataFrame, order: list[Column], normalized: str = "normalized_url", url: str = "url") -> DataFrame:
    """Incoming rows with ``existing_id`` and ``disposition``.

    'inserted', or 'duplicate' of a stored row or of an earlier one of the batch. Where the rows have a
    ``lane``, a stored row that is met on lane 'refresh' is 'refreshed_unchanged' if its hash is the
    incoming one and not empty, else 'refreshed_changed'. A duplicate leaves the stored row as it is;
    its links are still written. Of several stored rows with one address the least id counts.
    """
    hashed = F.col("content_hash") if "content_hash" in base.columns else F.lit(None).cast("string")
    stored = F.min(F.struct("id", hashed.alias("hash")))
    one, two = base.groupBy(F.col(normalized).alias("__n")).agg(stored.alias("__i")), base.groupBy(F.col(url).alias("__u")).agg(stored.alias("__j"))
    w = Window.partitionBy(normalized).orderBy(*order)
    joined = incoming.join(one, F.col(normalized) == F.col("__n"), "left").join(two, F.col(url) == F.col("__u"), "left")
    found = joined.withColumn("__s", F.coalesce("__i", "__j")).withColumn("existing_id", F.col("__s.id")).withColumn("__first", F.row_number().over(w))
    kind = F.when(F.col("existing_id").isNull() & (F.col("__first") == 1), "inserted")
    if "lane" in incoming.columns:
        same = (F.coalesce(F.col("__s.hash"), F.lit("")) != "") & (F.col("__s.hash") == F.col("content_hash"))
        kind = kind.when(F.col("existing_id").isNotNull() & (F.col("lane") == "refresh"), F.when(F.coalesce(same, F.lit(False)), "refreshed_unchanged").otherwise("refreshed_changed"))
    return found.withColumn("disposition", kind.otherwise("duplicate")).drop("__n", "__i", "__u", "__j", "__s", "__first")


def write_articles(judged: DataFrame, base: DataFrame, order: list[Column], always: list[str], if_changed: list[str]) -> DataFrame:
    """The new table of articles: the base with the inserted rows, and with the refreshed ones' columns patched.

    judged: incoming rows from :func:`dispositions`, with ``id`` of their own. Of several refreshes of
    one stored row the last in order counts.
    """
    new = judged.where("disposition = 'inserted'").select(*[c for c in base.columns if c in judged.columns])
    rank = F.row_number().over(Window.partitionBy("existing_id").orderBy(*[c.desc() for c in order]))
    refreshed = judged.where("disposition in ('refreshed_changed', 'refreshed_unchanged')").withColumn("__n", rank).where("__n = 1")
    updates = refreshed.select(F.col("existing_id").alias("id"), *dict.fromkeys([*always, *if_changed, "content_hash"]))
    return patch(base, updates, "id", always, if_changed).drop("changed").unionByName(new, allowMissingColumns=True)


def write_counts(judged: DataFrame, links: DataFrame, failed: str = "failed", source: str = "source_id") -> DataFrame:
    """One row for each source: articles by disposition and errors, links written and lost.

    judged: rows with ``disposition`` and the flag ``failed``; a failed row counts as an error only.
    links: (source, article_id, name), article_id null where its article failed; such links and links
    without a name are lost.
    """
    good = ~F.col(failed)
    counts = [F.count_if(good & (F.col("disposition") == d)).alias(f"articles_{n}") for d, n in (("inserted", "inserted"), ("duplicate", "duplicate"), ("refreshed_changed", "refreshed_changed"), ("refreshed_unchanged", "refreshed_unchanged"))]
    lost = F.col("article_id").isNull() | (F.coalesce(F.trim("name"), F.lit("")) == "")
    linked = links.groupBy(source).agg(F.count_if(~lost).alias("entity_links_success"), F.count_if(lost).alias("entity_links_errors"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    made = judged.groupBy(source).agg(*counts, F.count_if(failed).alias("articles_errors")).join(linked, source, "full_outer")
    return made.select(source, *[zero(c) for c in made.columns if c != source])


def patch(base: DataFrame, updates: DataFrame, key: str, always: list[str], if_changed: list[str], hash_column: str = "content_hash") -> DataFrame:
    """The base with the updates' columns: ``always`` in any case, ``if_changed`` where the hash is empty or differs; ``changed`` tells which (null: not touched)."""
    fresh = updates.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in dict.fromkeys([*always, *if_changed, hash_column])])
    joined = base.join(fresh, F.col(key) == F.col("__key"), "left")
    touched = F.col("__key").isNotNull()
    new_hash = F.col(f"__{hash_column}")
    changed = touched & ~((F.coalesce(new_hash, F.lit("")) != "") & F.coalesce(new_hash == F.col(hash_column), F.lit(False)))
    out = [F.when(touched, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in always else F.when(changed, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in if_changed else F.col(c) for c in base.columns]
    return joined.select(*out, F.when(touched, changed).alias("changed"))


def upsert_state(state: DataFrame, updates: DataFrame, key: str, given: list[str] | None = None) -> DataFrame:
    """Keyed state: for each key of the updates their values, else the old ones; keys of either side stay.

    A null in an update leaves the old value, but in the columns ``given`` it is a value like any other
    and clears the old one.
    """
    a, b = state.alias("a"), updates.alias("b")
    known = F.col(f"b.{key}").isNotNull()
    new = lambda c: F.when(known, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")) if c in (given or ()) else F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}"))
    columns = [new(c).alias(c) if c in updates.columns else F.col(f"a.{c}") for c in state.columns]
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer").select(*columns)


def backfill(df: DataFrame, column: str, *fallbacks: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(column, *fallbacks))


def policy(df: DataFrame, kind: str, policies: dict[str, tuple], override: Column, overriding: tuple, names: tuple[str, ...] = ("refresh_enabled", "refresh_window_days", "refresh_cadence_hours", "refresh_priority")) -> DataFrame:
    """Policy columns by kind; rows for which ``override`` holds take its values, wherever their kind points. Other kinds keep theirs."""
    made = {}
    for n, name in enumerate(names):
        value = F.when(override, F.lit(overriding[n]))
        for k, values in policies.items():
            value = value.when(F.col(kind) == k, F.lit(values[n]))
        made[name] = value.otherwise(F.col(name)) if name in df.columns else value
    return df.withColumns(made)


def resolve_entities(incoming: DataFrame, entities: DataFrame, canonical: str = "canonical_name", name: str = "name", kind: str = "entity_type") -> DataFrame:
    """Incoming names with ``entity_id``: that of the same canonical name and type where the canonical name is not blank, else of the same name and type, else null. Of several, the oldest."""
    aged = Window.partitionBy("__k", "__t").orderBy("created_at", "id")

    def oldest(key: str) -> DataFrame:
        rows = entities.where(F.coalesce(F.trim(key), F.lit("")) != "").select(F.col(key).alias("__k"), F.col(kind).alias("__t"), "created_at", "id")
        return rows.withColumn("__n", F.row_number().over(aged)).where("__n = 1").select("__k", "__t", F.col("id").alias("__id"))

    a, b = oldest(canonical), oldest(name)
    hit = incoming.join(a, (F.col(canonical) == F.col("__k")) & (F.col(kind) == F.col("__t")), "left").withColumnRenamed("__id", "__first").drop("__k", "__t")
    hit = hit.join(b, (F.col(name) == F.col("__k")) & (F.col(kind) == F.col("__t")), "left").drop("__k", "__t")
    return hit.withColumn("entity_id", F.coalesce("__first", "__id")).drop("__first", "__id")


def write_entities(incoming: DataFrame, entities: DataFrame, order: list[Column], canonical: str = "canonical_name", name: str = "name", kind: str = "entity_type") -> tuple[DataFrame, DataFrame]:
    """(the new table of entities, the incoming rows with entity_id).

    Names that the table lacks are added once each, the first of the batch by ``order``: names with one
    canonical name and type are one entity, or, without a canonical name, with one name and type.
    ``incoming`` has an ``id`` for the entity that a row makes if it is new.
    """
    hit = resolve_entities(incoming, entities, canonical, name, kind)
    blank = F.coalesce(F.trim(canonical), F.lit("")) == ""
    w = Window.partitionBy(F.when(blank, F.concat(F.lit("n:"), name)).otherwise(F.concat(F.lit("c:"), canonical)), kind).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    new = hit.where("entity_id is null").withColumn("entity_id", F.first("id").over(w))
    resolved = hit.where("entity_id is not null").unionByName(new)
    made = new.where("entity_id = id").select(*[c for c in entities.columns if c in new.columns])
    return entities.unionByName(made, allowMissingColumns=True), resolved


def not_null(tables: dict[str, DataFrame], columns: list[tuple[str, str]]) -> DataFrame:
    """(check_name, violations): the nulls of columns that must not have any; one scan for each table."""
    parts = []
    for name in dict.fromkeys(t for t, _ in columns):
        mine = [c for t, c in columns if t == name]
        counted = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in mine])
        parts.append(counted.select(F.explode(F.array(*[F.struct(F.lit(f"not null {name}.{c}").alias("check_name"), F.col(c).alias("violations")) for c in mine])).alias("x")).select("x.*"))
    return reduce(DataFrame.unionByName, parts)


def add_links(links: DataFrame, incoming: DataFrame, cleared: DataFrame | None = None, keys: tuple[str, str] = ("article_id", "entity_id")) -> DataFrame:
    """Links with the incoming pairs that are missing; those of ``cleared`` articles are dropped first."""
    kept = links if cleared is None else links.join(cleared.select(keys[0]).distinct(), keys[0], "left_anti")
    new = incoming.dropDuplicates(list(keys)).join(kept.select(*keys), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def duplicate_groups(entities: DataFrame, canonical: Column, kind: Column) -> DataFrame:
    """(canonical, kind, id, master_id, size) of each entity in a group of two or more; the master is the oldest, then the least id. Blank names and types make no group."""
    keyed = entities.withColumns({"__c": F.trim(canonical), "__t": F.trim(kind)}).where("coalesce(__c, '') <> '' and coalesce(__t, '') <> ''")
    masters = keyed.groupBy("__c", "__t").agg(F.min(F.struct("created_at", "id"))["id"].alias("master_id"), F.count(F.lit(1)).alias("size")).where("size > 1")
    return keyed.join(masters, ["__c", "__t"]).select(F.col("__c").alias("canonical"), F.col("__t").alias("kind"), "id", "master_id", "size")


def merge_entities(links: DataFrame, groups: DataFrame, role: str = "mentioned") -> DataFrame:
    """(article_id, entity_id, mention_count, role_in_article): links with duplicates replaced by their master, one row for each pair.

    Counts are added (null as 0); the role is the least of those given, ``role`` where none is.
    """
    to_master = groups.where("id <> master_id").select(F.col("id").alias("__dup"), "master_id")
    moved = links.join(to_master, F.col("entity_id") == F.col("__dup"), "left").withColumn("entity_id", F.coalesce("master_id", "entity_id"))
    return moved.groupBy("article_id", "entity_id").agg(F.sum(F.coalesce("mention_count", F.lit(0))).cast("long").alias("mention_count"), F.coalesce(F.min("role_in_article"), F.lit(role)).alias("role_in_article"))


def merge_summary(links: DataFrame, groups: DataFrame) -> DataFrame:
    """(groups_found, entities_to_merge, article_links_reassigned, article_links_merged, entities_deleted), one row."""
    duplicates = groups.where("id <> master_id").select(F.col("id").alias("entity_id"), "master_id")
    moved = links.select("article_id", "entity_id").distinct().join(duplicates, "entity_id")
    has = links.select("article_id", F.col("entity_id").alias("master_id")).distinct().withColumn("__has", F.lit(True))
    # the first duplicate of an article without its master's link is reassigned, the others are merged
    first = F.row_number().over(Window.partitionBy("article_id", "master_id").orderBy("entity_id"))
    judged = moved.join(has, ["article_id", "master_id"], "left").withColumn("reassigned", F.col("__has").isNull() & (first == 1))
    a = groups.agg(F.count_distinct("master_id").alias("groups_found"), F.count_if(F.col("id") != F.col("master_id")).alias("entities_to_merge"))
    b = judged.agg(F.count_if("reassigned").alias("article_links_reassigned"), F.count_if(~F.col("reassigned")).alias("article_links_merged"))
    return a.crossJoin(b).withColumn("entities_deleted", F.col("entities_to_merge"))


def cascade_delete(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str = "id") -> DataFrame:
    """Children of the remaining parents."""
    return children.join(parents.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_semi")


def deletable(parents: DataFrame, children: DataFrame, child_key: str, parent_key: str = "id") -> DataFrame:
    """Parents that no child refers to."""
    return parents.join(children.select(F.col(child_key).alias(parent_key)).distinct(), parent_key, "left_anti")


def delete_guarded(parents: DataFrame, wanted: DataFrame, children: DataFrame, child_key: str, parent_key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(the parents that stay, those of ``wanted`` whose deletion is refused): a parent that a child refers to is not deleted."""
    used = children.where(F.col(child_key).isNotNull()).select(F.col(child_key).alias(parent_key)).distinct()
    asked = wanted.select(parent_key).distinct()
    return parents.join(asked.join(used, parent_key, "left_anti"), parent_key, "left_anti"), asked.join(used, parent_key, "left_semi")


def violations(tables: dict[str, DataFrame], unique: dict[str, list[tuple[str, ...]]], references: list[tuple[str, str, str]]) -> DataFrame:
    """(check_name, violations) for each unique key (surplus rows) and reference (rows that point nowhere; null points nowhere too only if not null)."""
    parts = []
    for name, keys in unique.items():
        for key in keys:
            counted = tables[name].groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            parts.append(counted.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("violations")).withColumn("check_name", F.lit(f"unique {name}({','.join(key)})")))
    for child, column, parent in references:
        lost = tables[child].where(F.col(column).isNotNull()).join(tables[parent].select(F.col("id").alias(column)), column, "left_anti")
        parts.append(lost.agg(F.count(F.lit(1)).cast("long").alias("violations")).withColumn("check_name", F.lit(f"reference {child}.{column}")))
    return reduce(DataFrame.unionByName, parts).select("check_name", "violations")
