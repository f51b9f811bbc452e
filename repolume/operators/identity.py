"""Who wrote a commit: resolution of commit identities, and repair of those that stay unknown.

Hosted merges carry one shared committer name, so their accounts are resolved commit by commit. Any other
committer name is resolved once, through its first commit, and the result holds for all commits of that name.
Names without an account are looked up among the aliases, then among e-mails, names and logins of the users.

All name-level work is done on the distinct names; the commits are joined twice, by sha and by name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolume.fixed_values import SERVICE_COMMITTER
from repolume.functions.people import pseudonym
from repolume.functions.ranking import first_per_key
from repolume.operators.lookups import commit_accounts, known_only, lookup
from repolume.schemas import REPO


def _on(scope: Sequence[str], **keys: str) -> dict[str, str]:
    return {**{name: name for name in scope}, **keys}


def _own_account(name: Column) -> Column:
    return name.isNull() | (name == SERVICE_COMMITTER)


def representatives(
    commits: DataFrame, values: Sequence[str], scope: Sequence[str] = (REPO,), name: str = "committer_name",
    order: Sequence[str] = ("seq",),
) -> DataFrame:
    """One row per committer name: ``values`` of its first commit (NULLs included)."""
    first = F.min_by(F.struct(*values), F.struct(*order))
    return commits.groupBy(*scope, name).agg(first.alias("_first")).select(*scope, name, "_first.*")


def propagate_representative(
    commits: DataFrame, values: Sequence[str], scope: Sequence[str] = (REPO,), name: str = "committer_name",
    order: Sequence[str] = ("seq",),
) -> DataFrame:
    """Give every commit the ``values`` of its committer name's first commit; service commits keep their own."""
    reps = representatives(commits.where(~_own_account(F.col(name))), values, scope, name, order)
    take = {value: f"_rep_{value}" for value in values}
    found = lookup(commits, reps, _on(scope, **{name: name}), take, hot=True)
    own = _own_account(F.col(name))
    return found.select(
        *[
            F.when(own, F.col(column)).otherwise(F.col(f"_rep_{column}")).alias(column) if column in values else column
            for column in commits.columns
        ]
    )


def _first_user(order: Sequence[str]) -> Column:
    """The first user in order; the id decides ties, so the same rows give the same user in any input order."""
    return F.min_by("anonym_uuid", F.struct(*order, "anonym_uuid")).alias("anonym_uuid")


def alias_index(users: DataFrame, scope: Sequence[str] = (REPO,), order: Sequence[str] = ("seq",)) -> DataFrame:
    """Alias -> first user that carries it."""
    aliases = users.select(*scope, *order, "anonym_uuid", F.explode("alias").alias("key"))
    return aliases.groupBy(*scope, "key").agg(_first_user(order))


def attribute_index(users: DataFrame, scope: Sequence[str] = (REPO,), order: Sequence[str] = ("seq",)) -> DataFrame:
    """E-mail, name or login -> first user that has it in any of the three.

    This turns the condition "equals e-mail OR name OR login" into an equi-join on one key.
    """
    keys = users.select(*scope, *order, "anonym_uuid", F.explode(F.array("email", "name", "login")).alias("key"))
    return (
        keys.where(F.col("key").isNotNull())
        .groupBy(*scope, "key")
        .agg(_first_user(order))
    )


def match_names(
    names: DataFrame, users: DataFrame, name: str, scope: Sequence[str] = (REPO,), order: Sequence[str] = ("seq",)
) -> DataFrame:
    """Add ``alias_user`` and ``attribute_user`` to a frame of names."""
    on = _on(scope, **{name: "key"})
    names = lookup(names, alias_index(users, scope, order), on, {"anonym_uuid": "alias_user"})
    return lookup(names, attribute_index(users, scope, order), on, {"anonym_uuid": "attribute_user"})


def _settle(
    commits: DataFrame, reps: DataFrame, users: DataFrame, scope: Sequence[str], mode: str, name: str,
    user_order: Sequence[str],
) -> DataFrame:
    """Commits with their own account columns and the accounts of each name's first commit -> the final columns."""
    if mode not in ("representative", "per_commit"):
        raise ValueError(f"unknown mode {mode!r}")
    columns = [c for c in commits.columns if c not in ("author", "committer", "unknown_user")]
    names = reps.withColumnsRenamed({"author": "_ra", "committer": "_rc"})
    names = match_names(names, users, name, scope, user_order).withColumn(
        "_hit", F.coalesce("alias_user", "attribute_user")
    )
    take = {"_ra": "_ra", "_rc": "_rc", "_hit": "_hit"}
    joined = lookup(commits, names, _on(scope, **{name: name}), take, hot=True)
    own = _own_account(F.col(name)) if mode == "representative" else F.lit(True)
    joined = joined.withColumns(
        {
            "_a": F.when(own, F.col("author")).otherwise(F.col("_ra")),
            "_c": F.when(own, F.col("committer")).otherwise(F.col("_rc")),
        }
    )
    unresolved = F.col("_a").isNull() & F.col("_c").isNull()
    hit = F.when(unresolved, F.col("_hit"))
    return joined.select(
        *columns,
        F.coalesce(hit, F.col("_a")).alias("author"),
        F.coalesce(hit, F.col("_c")).alias("committer"),
        F.when(unresolved & F.col("_hit").isNull(), F.col(name)).alias("unknown_user"),
    )


def resolve(
    commits: DataFrame, users: DataFrame, scope: Sequence[str] = (REPO,), order: Sequence[str] = ("seq",),
    mode: str = "representative", name: str = "committer_name", user_order: Sequence[str] = ("seq",),
) -> DataFrame:
    """Final ``author``, ``committer`` and ``unknown_user`` of commits that carry their own account columns.

    ``mode="representative"`` resolves a name through its first commit; ``"per_commit"`` uses every commit's
    own accounts. A name is looked up among the users only if both columns are NULL, aliases before
    attributes; a hit sets both, a miss is reported in ``unknown_user``.
    """
    reps = representatives(commits, ["author", "committer"], scope, name, order)
    return _settle(commits, reps, users, scope, mode, name, user_order)


def resolve_commits(
    commits: DataFrame, accounts: DataFrame, users: DataFrame, scope: Sequence[str] = (REPO,),
    order: Sequence[str] = ("seq",), mode: str = "representative", name: str = "committer_name",
    user_order: Sequence[str] = ("seq",),
) -> DataFrame:
    """``resolve`` for commits whose accounts are in a table of their own.

    The first commit of a name is found before its accounts are looked up, so the lookup for the names takes
    one row per name and shares the shuffled accounts with the lookup for the commits.
    """
    firsts = representatives(commits, ["commit_sha"], scope, name, order)
    reps = commit_accounts(firsts, accounts, scope).drop("commit_sha")
    return _settle(commit_accounts(commits, accounts, scope), reps, users, scope, mode, name, user_order)


def unknown_users(commits: DataFrame, scope: Sequence[str] = (REPO,)) -> DataFrame:
    """Unresolved names with the number of their commits."""
    named = commits.where(F.col("unknown_user").isNotNull())
    return named.groupBy(*scope, "unknown_user").agg(F.count("*").alias("commits"))


def assign_unknown_users(
    commits: DataFrame, users: DataFrame, mapping: DataFrame, scope: Sequence[str] = (REPO,), salt: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Give unresolved names to users, in bulk. Returns the new commits and users.

    ``mapping`` has ``unknown_user, uuid, new_user, seq``. A name that no commit is waiting for is ignored, and
    the first line of a name counts. A known uuid gets the name as a further alias; an unknown one becomes a
    new user with that id, under a pseudonym (``new_user``) or under the uuid as given.
    """
    scope = list(scope)
    waiting = commits.where(F.col("unknown_user").isNotNull()).select(*scope, "unknown_user").distinct()
    lines = first_per_key(mapping, [*scope, "unknown_user"], [F.col("seq"), F.col("uuid")])
    lines = known_only(lines, waiting, [*scope, "unknown_user"])
    by_uuid = users.groupBy(*scope, "anonym_uuid").agg(F.lit(True).alias("_known"))
    by_id = users.where(F.col("id").isNotNull()).groupBy(*scope, "id").agg(F.min_by("anonym_uuid", F.struct("seq", "anonym_uuid")).alias("_of_id"))
    lines = lookup(lines, by_uuid, _on(scope, uuid="anonym_uuid"), {"_known": "_known"})
    lines = lookup(lines, by_id, _on(scope, uuid="id"), {"_of_id": "_of_id"})
    # A new uuid named by several lines is created by the first of them. A later line without ``new_user`` then
    # finds it by uuid, unless the first one hid the uuid behind a pseudonym.
    fresh = F.col("_known").isNull() & F.col("_of_id").isNull()
    created = first_per_key(lines.where(fresh), [*scope, "uuid"], [F.col("seq"), F.col("unknown_user")])
    created = created.withColumn(
        "_created", F.when(F.col("new_user"), pseudonym(F.col("uuid"), salt)).otherwise(F.col("uuid"))
    )
    lines = lookup(
        lines, created, _on(scope, uuid="uuid"), {"_created": "_created", "unknown_user": "_creator"}
    ).withColumn("_target", F.when(F.col("_known"), F.col("uuid")).otherwise(F.coalesce("_of_id", "_created")))

    became_known = F.coalesce(F.col("_created") == F.col("uuid"), F.lit(False)) & (F.col("_creator") != F.col("unknown_user"))
    extra = (
        lines.where(F.col("_known").isNotNull() | became_known)
        .groupBy(*scope, F.col("_target").alias("anonym_uuid"))
        .agg(F.sort_array(F.collect_set("unknown_user")).alias("_names"))
    )
    new_rows = created.select(
        *scope,
        F.col("_created").alias("anonym_uuid"),
        F.col("uuid").alias("id"),
        F.col("unknown_user").alias("name"),
        "seq",
    )
    # new users come after the stored ones, whose last position is one row per repository
    last = users.groupBy(*scope).agg(F.max("seq").alias("_last")).withColumn("_all", F.lit(0))
    new_rows = lookup(new_rows.withColumn("_all", F.lit(0)), last, _on(scope, _all="_all"), {"_last": "_last"})
    new_rows = new_rows.withColumn("seq", F.coalesce("_last", F.lit(-1)) + 1 + F.col("seq"))
    all_users = users.unionByName(new_rows.select(*[c for c in new_rows.columns if c in users.columns]), True)
    all_users = lookup(all_users, extra, _on(scope, anonym_uuid="anonym_uuid"), {"_names": "_names"})
    merged = F.array_distinct(F.concat(F.coalesce("alias", F.array().cast("array<string>")), F.col("_names")))
    all_users = all_users.withColumn("alias", F.when(F.col("_names").isNotNull(), merged).otherwise(F.col("alias")))

    found = lookup(commits, lines, _on(scope, unknown_user="unknown_user"), {"_target": "_target"}, hot=True)
    new_commits = found.withColumns(
        {
            "author": F.coalesce("_target", "author"),
            "committer": F.coalesce("_target", "committer"),
            "unknown_user": F.when(F.col("_target").isNull(), F.col("unknown_user")),
        }
    )
    return new_commits.select(*commits.columns), all_users.select(*users.columns)
