"""One object for the usual work: land, build, check, read, repair, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from repolume.functions.people import People
from repolume.operators import projections
from repolume.operators.aggregates import repository_summary
from repolume.operators.filters import select_repositories
from repolume.operators.identity import unknown_users
from repolume.operators.incremental import children_per_repository, content_per_repository, next_pages, updates_per_repository
from repolume.operators.lookups import known_only
from repolume.operators.setops import concat
from repolume.plans.activity import attach_parents, build_tables, child_table, cursors, merge_table, summary_sources
from repolume.plans.completion import read_wanted_issues, settle_wanted_issues
from repolume.plans.selection import TableSelection
from repolume.plans.summary import SUMMARY_KEYS, distinct_keys, keys_path, refresh_summary, summary_keys
from repolume.plans.versions import COMMIT_STATE, commit_state, refresh_versions, repair_identities, state_path
from repolume.schemas import LISTED_UNDER, RAW, REPO, TABLES
from repolume.session import remove, scratch_dir
from repolume.sinks.tables import add_repositories, append_users, buckets_of, catalog, export_tables, save_state, save_table
from repolume.sources.mined import read_mined_commits, read_mined_edits
from repolume.sources.pages import read_pages
from repolume.sources.tables import read_registry, read_table
from repolume.streaming.ingest import stream_into_store, stream_pages

# Raw entities that stand or fall with one listing: entity of the listing -> what is built from it, its
# projection, its stored table and its time. Releases have no update time: drafts and edits show in the content only.
_LISTINGS = {
    "issue": (
        ("issue", "issue_comment", "issue_event", "listed_issue_reaction"), projections.issues, "issues", "updated_at",
    ),
    "pull_request": (
        ("pull_request", "review_comment", "listed_review", "listed_pull_reaction"), projections.pull_requests,
        "pull_requests", "updated_at",
    ),
    "release": (("release",), projections.releases, "releases", None),
    "workflow": (("workflow",), projections.workflows, "workflows", "updated_at"),
    "workflow_run": (("workflow_run",), projections.workflow_runs, "workflow_runs", "updated_at"),
}
# Listing -> tables of what changes without the update time of the listed records.
_CHILDREN = {"issue": ("issue_reactions",), "pull_request": ("reviews", "pull_request_reactions")}
# Raw entity -> its projection and table, where one landed record is one row.
_STREAMED = {
    "issue": (projections.issues, "issues"), "issue_comment": (projections.issue_comments, "issue_comments"),
    "issue_event": (projections.issue_events, "issue_events"),
    "review_comment": (projections.review_comments, "review_comments"), "release": (projections.releases, "releases"),
    "workflow": (lambda raw, _: projections.workflows(raw), "workflows"),
    "workflow_run": (lambda raw, _: projections.workflow_runs(raw), "workflow_runs"),
}
# Table -> what its rows are made from: a repository landed there is replaced in the table.
_ORIGINS = {
    "issues": ("issue",), "issue_comments": ("issue_comment", "issue"), "issue_events": ("issue_event", "issue"),
    "issue_reactions": ("issue", "issue_comment", "listed_issue_reaction"), "pull_requests": ("pull_request",),
    "reviews": ("pull_request", "listed_review"), "review_comments": ("review_comment", "pull_request"),
    "pull_request_reactions": ("review_comment", "pull_request", "listed_pull_reaction"),
    "releases": ("release",), "workflows": ("workflow",), "workflow_runs": ("workflow_run",),
    "commits": ("mined_commits",), "edits": ("mined_edits",), "branches": ("mined_commits",),
}


class Workspace:
    """Tables stored below ``root``, built from what is landed below ``landing``.

    Landing layout: ``<landing>/<entity>/`` JSON pages for each raw entity, ``<landing>/mined_commits/`` and
    ``<landing>/mined_edits/`` Parquet. Pages of reviews and reactions name the record they are listed under in
    ``parent`` (kind, id, url). One call works on all landed repositories together.
    """

    def __init__(self, spark: SparkSession, root: str, people: People | None = None) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.people = people or People()

    # ------------------------------------------------------------------------------------------- repositories

    @property
    def registry_path(self) -> str:
        return f"{self.root}/repositories"

    def repositories(self, whitelist: list[str] | None = None, blacklist: list[str] | None = None) -> DataFrame:
        """Registered repositories whose name passes the patterns."""
        return select_repositories(read_registry(self.spark, self.registry_path), whitelist, blacklist, REPO)

    def register(self, names: DataFrame) -> None:
        add_repositories(self.spark, self.registry_path, names)

    # ------------------------------------------------------------------------------------------------ building

    def landed(self, landing: str) -> dict[str, DataFrame]:
        """Raw records by entity; an entity that was not landed has no rows."""
        return {entity: read_pages(self.spark, f"{landing}/{entity}", entity) for entity in RAW if entity != "user"}

    def _columnar(self, raw: dict[str, DataFrame], folders: list[str]) -> dict[str, DataFrame]:
        """Raw records as Parquet in the shared scratch folder.

        Users, tables and the lists of repositories all read them; this way the JSON is parsed once, and each
        reader takes the columns it needs.
        """
        copies = {}
        for entity, df in raw.items():
            path = scratch_dir(self.spark, f"landed-{entity}")
            folders.append(path)
            df.write.parquet(path)
            copies[entity] = self.spark.read.schema(df.schema).parquet(path)
        return copies

    def _land(self, landing: str, folders: list[str]) -> dict[str, DataFrame]:
        """What is landed, parsed once; reviews and reactions of listings led to their parents, landed or stored."""
        raw = self._columnar(self.landed(landing), folders)
        # only issues and pull requests of the repositories that list something under them are read
        touched = buckets_of(concat(*[raw[entity].select(REPO) for entity in LISTED_UNDER]))
        stored = {
            kind: read_table(self.spark, self.root, table, buckets=touched)
            for kind, table in (("issue", "issues"), ("pull_request", "pull_requests"))
        }
        attached = attach_parents(raw, stored)
        listed = {entity: df for entity, df in attached.items() if entity not in raw}
        return {**{e: df for e, df in attached.items() if e in raw}, **self._columnar(listed, folders)}

    def _only_updated(
        self, raw: dict[str, DataFrame], selection: TableSelection, folders: list[str]
    ) -> dict[str, DataFrame]:
        """Without the repositories whose listings show nothing new.

        The verdicts are written down: they come from the stored tables, which are about to be replaced.
        Reactions and reviews change without the update time of their parent, so if they are selected, they are
        compared with the stored ones as whole sets.
        """
        kept, selected = dict(raw), selection.tables()
        for entity, (members, project, table, time) in _LISTINGS.items():
            listed, stored = project(raw[entity]), read_table(self.spark, self.root, table)
            if time is None:
                listed = projections.releases(raw[entity], self.people)
                verdict = content_per_repository(listed, stored)
            else:
                verdict = updates_per_repository(listed, stored, time)
            verdicts = [verdict]
            for child in _CHILDREN.get(entity, ()):
                if child in selected:
                    landed = concat(*[raw[origin].select(REPO) for origin in _ORIGINS[child]]).distinct()
                    before = read_table(self.spark, self.root, child, buckets=buckets_of(landed))
                    verdicts.append(children_per_repository(landed, child_table(child, raw, self.people), before))
            path = scratch_dir(self.spark, f"updated-{entity}")
            folders.append(path)
            concat(*verdicts).where("has_updates").select(REPO).distinct().write.parquet(path)
            updated = self.spark.read.schema(f"{REPO} string").parquet(path)
            kept.update({member: known_only(raw[member], updated, [REPO]) for member in members})
        return kept

    def generate(self, landing: str, selection: TableSelection | None = None, check_for_updates: bool = False) -> None:
        """Build the selected tables of all landed repositories and store them.

        The tables of a landed repository are replaced; users are added. With ``check_for_updates`` the
        repositories whose listings show nothing new are left as they are.
        """
        selection = selection or TableSelection()
        folders: list[str] = []
        raw = self._land(landing, folders)
        commits = read_mined_commits(self.spark, f"{landing}/mined_commits")
        edits = read_mined_edits(self.spark, f"{landing}/mined_edits")
        counted = summary_sources(raw, commits)
        if check_for_updates:
            raw = self._only_updated(raw, selection, folders)
        # users first: those stored keep their pseudonym and their aliases, which resolve the commits
        everyone = build_tables(raw, TableSelection().all_false(), self.people)["users"]
        append_users(everyone, self.root)
        users = read_table(self.spark, self.root, "users")
        tables = build_tables(raw, selection, self.people, commits, edits, users, counted)
        landed = {**raw, "mined_commits": commits, "mined_edits": edits}
        for name, df in tables.items():
            if name == "repository":
                save_table(df, self.root, name)
            elif name != "users":
                save_table(df, self.root, name, concat(*[landed[origin].select(REPO) for origin in _ORIGINS[name]]))
        if "commits" in tables:  # what a later part of the logs is resolved with
            accounts = projections.commit_accounts(raw["commit_account"], self.people)
            state = commit_state(commits, accounts, projections.tags(raw["tag"]))
            save_state(state, state_path(self.root), COMMIT_STATE, commits)
        if "repository" in tables:  # what a later landing is counted together with
            keys = summary_keys(counted, projections.commit_log(commits), projections.edits(edits))
            landed_in = concat(raw["repository"].select(REPO), *[df.select(REPO) for df in (*counted.values(), edits)])
            save_state(distinct_keys(keys), keys_path(self.root), SUMMARY_KEYS, landed_in)
        self._want_issues(raw, tables)
        for folder in folders:
            remove(self.spark, folder)

    def refresh(self, landing: str, selection: TableSelection | None = None) -> None:
        """Lay a partial landing (pages since a cursor) over what is stored.

        Of a record with an update time the newest version stays; of other records the landed one. Records that
        were not landed stay as they are. Parts of the mined logs are resolved together with what is stored of their
        repositories. The repository summary counts what is stored and what is landed together; select it in every
        landing or in none, as what lands without it is not counted later.
        """
        selection = selection or TableSelection()
        folders: list[str] = []
        raw = self._land(landing, folders)
        tables = build_tables(raw, selection, self.people)
        append_users(tables.pop("users"), self.root)
        for name, df in tables.items():
            if name != "repository":
                merge_table(df, self.root, name)
        self._want_issues(raw, tables)
        commits = read_mined_commits(self.spark, f"{landing}/mined_commits")
        edits = read_mined_edits(self.spark, f"{landing}/mined_edits")
        if "repository" in selection.tables():
            keys = summary_keys(summary_sources(raw, commits), projections.commit_log(commits), projections.edits(edits))
            described = repository_summary(raw["repository"], {}, companies=selection.repository.contributor_companies)
            refresh_summary(self.spark, self.root, keys, described)
        if "commits" in selection.tables():
            refresh_versions(
                self.spark, self.root, commits, edits,
                projections.commit_accounts(raw["commit_account"], self.people), read_table(self.spark, self.root, "users"),
                projections.tags(raw["tag"]),
            )
        for folder in folders:
            remove(self.spark, folder)

    def _want_issues(self, raw: dict[str, DataFrame], tables: dict[str, DataFrame]) -> None:
        """Bring the ledger of wanted issues up to date for the repositories whose issues or pull requests landed."""
        if "issues" in tables or "pull_requests" in tables:
            settle_wanted_issues(self.spark, self.root, concat(raw["issue"].select(REPO), raw["pull_request"].select(REPO)))

    def wanted_issues(self) -> DataFrame:
        """``repo_full_name, number, pull_request_id``: stored pull requests whose issue has not landed yet."""
        return read_wanted_issues(self.spark, self.root)

    def ingest(self, entity: str, pages: str, checkpoint: str, max_files: int = 1000) -> None:
        """Stream landed pages of an entity into its table, from where the last call stopped."""
        project, table = _STREAMED[entity]
        stream = stream_pages(self.spark, pages, entity, max_files)
        stream_into_store(stream, self.root, table, checkpoint, lambda raw: project(raw, self.people)).awaitTermination()

    def next_pages(self, name: str, cursors: DataFrame, limit: int) -> DataFrame:
        """The next records of a table after each repository's own cursor (``repo_full_name, updated_at, id``)."""
        return next_pages(self.table(name), cursors, limit)

    def cursors(self, name: str) -> DataFrame:
        """Per repository the time and id after which a listing of the table goes on."""
        return cursors(name, self.table(name))

    # ------------------------------------------------------------------------------------------------- reading

    def table(self, name: str, repositories: list[str] | None = None) -> DataFrame:
        return read_table(self.spark, self.root, name, repositories)

    def catalog(self) -> DataFrame:
        return catalog(self.spark, self.root)

    def export(self, folder: str, source: str = "csv", repositories: list[str] | None = None) -> None:
        """Every table, one folder each."""
        export_tables({name: self.table(name, repositories) for name in TABLES}, folder, source)

    # ---------------------------------------------------------------------------------------------- identities

    def unknown_users(self) -> DataFrame:
        return unknown_users(self.table("commits"))

    def assign_unknown_users(self, mapping: DataFrame) -> None:
        """``mapping``: ``repo_full_name, seq, unknown_user, uuid, new_user``."""
        repair_identities(self.spark, self.root, mapping, self.people.salt)

    def assign_unknown_user(self, repository: str, unknown_user: str, uuid: str, new_user: bool = False) -> None:
        """One line of ``assign_unknown_users``."""
        schema = "repo_full_name string, seq long, unknown_user string, uuid string, new_user boolean"
        self.assign_unknown_users(self.spark.createDataFrame([(repository, 0, unknown_user, uuid, new_user)], schema))
