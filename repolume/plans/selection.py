"""Switches that choose the tables to build.

Tables are lazy, so a table that is not selected costs nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from typing import TypeVar

S = TypeVar("S", bound="Selection")


@dataclass
class Selection:
    """Base of the switch classes: booleans and nested selections."""

    def _parts(self) -> list["Selection"]:
        return [getattr(self, f.name) for f in fields(self) if isinstance(getattr(self, f.name), Selection)]

    def _switches(self) -> list[str]:
        return [f.name for f in fields(self) if isinstance(getattr(self, f.name), bool)]

    def _set(self, value: bool, parts: bool) -> None:
        for name in self._switches():
            setattr(self, name, value)
        if parts:
            for part in self._parts():
                part._set(value, parts)

    def all_true(self: S, parts: bool = True) -> S:
        self._set(True, parts)
        return self

    def all_false(self: S, parts: bool = True) -> S:
        self._set(False, parts)
        return self

    def reset(self: S) -> S:
        """Back to the defaults, nested selections included."""
        for name, value in vars(type(self)()).items():
            setattr(self, name, value)
        return self

    def has_true(self) -> bool:
        return any(getattr(self, name) for name in self._switches())

    def has_false(self) -> bool:
        return not all(getattr(self, name) for name in self._switches())


@dataclass
class IssueSelection(Selection):
    issues: bool = True
    reactions: bool = False
    events: bool = True
    comments: bool = True

    def tables(self) -> set[str]:
        """Reactions hang on issues and comments; reactions alone still build the issues."""
        wanted = set()
        if self.issues or self.reactions:
            wanted.add("issues")
        if self.events:
            wanted.add("issue_events")
        if self.comments:
            wanted.add("issue_comments")
        if self.reactions:
            wanted.add("issue_reactions")
        return wanted


@dataclass
class PullRequestSelection(Selection):
    pull_requests: bool = True
    deep: bool = False
    commits: bool = False
    review_requests: bool = False
    review_comments: bool = True
    reactions: bool = False
    reviews: bool = False
    issues: IssueSelection = field(default_factory=IssueSelection)

    def tables(self) -> set[str]:
        """Deep columns, review requests and commits are columns of the pull requests; so they imply them.

        Pull requests in turn need the issues that describe them.
        """
        wanted = set()
        implied = self.pull_requests or self.deep or self.commits or self.review_requests
        if implied or self.reactions or self.reviews:
            wanted.add("pull_requests")
        if self.review_comments:
            wanted.add("review_comments")
        if self.reviews:
            wanted.add("reviews")
        if self.reactions and self.review_comments:
            wanted.add("pull_request_reactions")
        if "pull_requests" in wanted:
            wanted |= {"issues", *self.issues.tables()}
        return wanted


@dataclass
class RepositorySelection(Selection):
    summary: bool = True
    contributor_companies: bool = True

    def tables(self) -> set[str]:
        """The companies are columns of the summary, which is built without them too."""
        return {"repository"} if self.summary or self.contributor_companies else set()


@dataclass
class WorkflowSelection(Selection):
    workflows: bool = True
    runs: bool = True

    def tables(self) -> set[str]:
        switches = {"workflows": self.workflows, "workflow_runs": self.runs}
        return {name for name, wanted in switches.items() if wanted}


@dataclass
class TableSelection(Selection):
    """Everything."""

    releases: bool = True
    versions: bool = True
    issues: IssueSelection = field(default_factory=IssueSelection)
    pull_requests: PullRequestSelection = field(default_factory=PullRequestSelection)
    repository: RepositorySelection = field(default_factory=RepositorySelection)
    workflows: WorkflowSelection = field(default_factory=WorkflowSelection)

    def tables(self) -> set[str]:
        wanted = {"users"}
        if self.releases:
            wanted.add("releases")
        if self.versions:
            wanted |= {"commits", "edits", "branches"}
        for part in (self.issues, self.pull_requests, self.repository, self.workflows):
            wanted |= part.tables()
        return wanted
