"""Raw record schemas, table schemas and the table catalog.

A raw schema lists every optional source field, so a key that is absent from a landed record reads as NULL and
every table always has all of its columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from repolume.fixed_values import COMMUNITY_FILES

STRING, LONG, BOOL, TS = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampType()
STRINGS, LONGS = T.ArrayType(STRING), T.ArrayType(LONG)

REPO = "repo_full_name"


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def many(kind: T.DataType) -> T.ArrayType:
    return T.ArrayType(kind)


# ---------------------------------------------------------------------------------------------- raw records

USER = struct(node_id=STRING, name=STRING, email=STRING, login=STRING)
REACTION = struct(id=LONG, content=STRING, created_at=TS, user=USER)
ISSUE_EVENT = struct(
    id=LONG, event=STRING, commit_id=STRING, created_at=TS, actor=USER, assignee=USER, assigner=USER,
    label=struct(name=STRING), issue=struct(id=LONG),
)
ISSUE = struct(
    id=LONG, number=LONG, title=STRING, body=STRING, state=STRING, url=STRING, locked=BOOL,
    active_lock_reason=STRING, comments=LONG, created_at=TS, updated_at=TS, closed_at=TS, user=USER,
    closed_by=USER, assignees=many(USER), labels=many(struct(name=STRING)), pull_request=struct(url=STRING),
    reactions=many(REACTION), events=many(ISSUE_EVENT),
)
ISSUE_COMMENT = struct(
    id=LONG, issue_url=STRING, body=STRING, created_at=TS, updated_at=TS, user=USER, reactions=many(REACTION),
)
REVIEW = struct(id=LONG, body=STRING, state=STRING, submitted_at=TS, user=USER)
PULL_REQUEST = struct(
    id=LONG, number=LONG, merged_at=TS, merge_commit_sha=STRING, draft=BOOL, updated_at=TS, url=STRING,
    additions=LONG, changed_files=LONG, comments=LONG, commits_count=LONG, deletions=LONG, mergeable=BOOL,
    mergeable_state=STRING, merged=BOOL, rebaseable=BOOL, review_comments=LONG, maintainer_can_modify=BOOL,
    merged_by=USER, reviews=many(REVIEW), requested_users=many(USER), commits=many(struct(sha=STRING)),
)
REVIEW_COMMENT = struct(
    id=LONG, pull_request_url=STRING, body=STRING, commit_id=STRING, original_commit_id=STRING,
    diff_hunk=STRING, path=STRING, position=LONG, original_position=LONG, created_at=TS, updated_at=TS,
    user=USER, reactions=many(REACTION),
)
RELEASE = struct(
    id=LONG, title=STRING, body=STRING, tag_name=STRING, target_commitish=STRING, draft=BOOL, prerelease=BOOL,
    created_at=TS, published_at=TS, author=USER,
)
WORKFLOW = struct(id=LONG, name=STRING, state=STRING, created_at=TS, updated_at=TS)
WORKFLOW_RUN = struct(
    id=LONG, workflow_id=LONG, head_sha=STRING, status=STRING, event=STRING, conclusion=STRING, created_at=TS,
    updated_at=TS, pull_requests=many(struct(id=LONG)),
)
TAG = struct(name=STRING, commit=struct(sha=STRING))
COMMIT_ACCOUNT = struct(sha=STRING, author=USER, committer=USER)
REPOSITORY = struct(
    name=STRING, full_name=STRING, created_at=TS, stargazers_count=LONG, size=LONG, url=STRING,
    html_url=STRING, has_wiki=BOOL, has_pages=BOOL, has_projects=BOOL, has_downloads=BOOL,
    watchers_count=LONG, fork=BOOL, language=STRING, organization=struct(name=STRING, type=STRING),
    readme_content=STRING, contributors=many(struct(node_id=STRING, company=STRING)),
)

# Reviews and reactions are listed under one record, which their pages name by kind and id, by url, or by both.
PARENT = struct(kind=STRING, id=LONG, url=STRING)
LISTED_UNDER = ("review", "reaction")

# Records that are counted only.
LISTED = struct(id=LONG)

RAW = {
    "issue": ISSUE, "issue_comment": ISSUE_COMMENT, "issue_event": ISSUE_EVENT, "reaction": REACTION,
    "pull_request": PULL_REQUEST, "review": REVIEW, "review_comment": REVIEW_COMMENT, "release": RELEASE,
    "workflow": WORKFLOW, "workflow_run": WORKFLOW_RUN, "tag": TAG, "commit_account": COMMIT_ACCOUNT,
    "repository": REPOSITORY, "user": USER, "label": LISTED, "milestone": LISTED, "contributor": LISTED,
    "commit_comment": LISTED,
}


def raw_frame_schema(record: T.StructType) -> T.StructType:
    """Schema of raw records as a DataFrame: repository, position in the listing, record fields."""
    return T.StructType([T.StructField(REPO, STRING), T.StructField("seq", LONG), *record.fields])


# The mined version tables, as the commit miner writes them.
MINED_COMMITS = struct(
    repo_full_name=STRING, seq=LONG, hash=STRING, author_name=STRING, author_email=STRING, author_date=STRING,
    author_timezone=LONG, committer_name=STRING, committer_email=STRING, committer_date=STRING,
    committer_timezone=LONG, commit_message=STRING, commit_message_len=LONG, no_of_modifications=LONG,
    parents=STRING, branches=STRING, in_main_branch=BOOL, merge=BOOL, project_name=STRING,
)
MINED_EDITS = struct(
    repo_full_name=STRING, id=LONG, commit_hash=STRING, filename=STRING, edit_type=STRING,
    modification_type=STRING, parent_sha=STRING, total_added_lines=LONG, total_removed_lines=LONG,
    levenshtein_dist=LONG, pre_text=STRING, post_text=STRING,
)

# --------------------------------------------------------------------------------------------------- tables

_REACTIONS = dict(
    repo_full_name=STRING, id=LONG, parent_id=LONG, parent_name=STRING, content=STRING, author=STRING,
    created_at=TS,
)


@dataclass(frozen=True)
class TableSpec:
    """One table of the catalog: its folder, name, schema and primary key."""

    folder: str
    name: str
    schema: T.StructType
    key: str

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def _spec(folder: str, name: str, key: str = "id", /, **fields: T.DataType) -> TableSpec:
    return TableSpec(folder, name, struct(**fields), key)


TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        _spec(
            "Releases", "releases", repo_full_name=STRING, id=LONG, title=STRING, body=STRING, tag_name=STRING,
            target_commitish=STRING, draft=BOOL, prerelease=BOOL, author=STRING, created_at=TS, published_at=TS,
        ),
        _spec(
            "Issues", "issues", repo_full_name=STRING, id=LONG, number=LONG, title=STRING, body=STRING,
            state=STRING, url=STRING, locked=BOOL, active_lock_reason=STRING, comments=LONG, labels=STRINGS,
            assignees=STRINGS, author=STRING, closed_by=STRING, created_at=TS, updated_at=TS, closed_at=TS,
            is_pull_request=BOOL,
        ),
        _spec(
            "Issues", "issue_comments", repo_full_name=STRING, id=LONG, issue_url=STRING, author=STRING,
            body=STRING, created_at=TS, updated_at=TS,
        ),
        _spec("Issues", "issue_reactions", **_REACTIONS),
        _spec(
            "Issues", "issue_events", repo_full_name=STRING, id=LONG, issue_id=LONG, author=STRING,
            assignee=STRING, assigner=STRING, commit_sha=STRING, event=STRING, label=STRING, created_at=TS,
        ),
        _spec(
            "PullRequests", "pull_requests", repo_full_name=STRING, id=LONG, number=LONG, merged_at=TS,
            merge_commit_sha=STRING, draft=BOOL, updated_at=TS, url=STRING, additions=LONG, changed_files=LONG,
            comments=LONG, commits=LONG, deletions=LONG, mergeable=BOOL, mergeable_state=STRING, merged=BOOL,
            rebaseable=BOOL, review_comments=LONG, maintainer_can_modify=BOOL, merged_by=STRING,
            review_requested_users=STRINGS, commit_shas=STRINGS,
        ),
        _spec(
            "PullRequests", "review_comments", repo_full_name=STRING, id=LONG, pull_request_url=STRING,
            author=STRING, body=STRING, commit_sha=STRING, original_commit_id=STRING, diff_hunk=STRING,
            path=STRING, position=LONG, original_position=LONG, created_at=TS, updated_at=TS,
        ),
        _spec("PullRequests", "pull_request_reactions", **_REACTIONS),
        _spec(
            "PullRequests", "reviews", repo_full_name=STRING, id=LONG, pull_request_id=LONG, author=STRING,
            body=STRING, state=STRING, submitted_at=TS,
        ),
        _spec(
            "Repository", "repository", REPO, repo_full_name=STRING, repo_name=STRING, organization_name=STRING,
            repo_type=STRING, user_name=STRING, creation_date=TS, stars=LONG, size=LONG, contributor_count=LONG,
            contributor_companies=STRINGS, contributor_companies_count=LONG, repo_url=STRING,
            repo_html_url=STRING, branch_count=LONG, commit_count=LONG, commit_comment_count=LONG,
            last_commit_date=TS, labels_count=LONG, tag_count=LONG, milestone_count=LONG, pullrequest_count=LONG,
            pullrequest_review_count=LONG, release_count=LONG, workflow_count=LONG, readme_length=LONG,
            issues_count=LONG, issues_comment_count=LONG, has_wiki=BOOL, has_pages=BOOL, has_projects=BOOL,
            has_downloads=BOOL, watchers_count=LONG, is_fork=BOOL, prog_language=STRING,
            **{name: TS for name in COMMUNITY_FILES},
        ),
        _spec(
            "Versions", "commits", "commit_sha", repo_full_name=STRING, commit_sha=STRING, author=STRING,
            committer=STRING, unknown_user=STRING, commited_at=TS, committer_timezone=LONG, commit_message=STRING,
            parent_sha=STRING, no_of_modifications=LONG, in_main_branch=BOOL, tag=STRING, branch_ids=LONGS,
        ),
        _spec(
            "Versions", "edits", repo_full_name=STRING, id=LONG, commit_sha=STRING, filename=STRING,
            edit_type=STRING, modification_type=STRING, parent_sha=STRING, total_added_lines=LONG,
            total_removed_lines=LONG, levenshtein_dist=LONG, pre_text=STRING, post_text=STRING,
        ),
        _spec("Versions", "branches", repo_full_name=STRING, id=LONG, branch_names=STRING),
        _spec(
            "Workflows", "workflows", repo_full_name=STRING, id=LONG, name=STRING, state=STRING, created_at=TS,
            updated_at=TS,
        ),
        _spec(
            "Workflows", "workflow_runs", repo_full_name=STRING, id=LONG, workflow_id=LONG, commit_sha=STRING,
            state=STRING, event=STRING, conclusion=STRING, pull_requests=LONGS, created_at=TS, updated_at=TS,
        ),
        _spec(
            "", "users", "anonym_uuid", repo_full_name=STRING, anonym_uuid=STRING, id=STRING, name=STRING,
            email=STRING, login=STRING, alias=STRINGS, seq=LONG,
        ),
    )
}

REGISTRY = struct(repos=STRINGS)


def tables_by_folder() -> dict[str, list[str]]:
    """Folder -> table names, in catalog order."""
    folders: dict[str, list[str]] = {}
    for spec in TABLES.values():
        folders.setdefault(spec.folder, []).append(spec.name)
    return folders
