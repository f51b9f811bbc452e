"""They are part of the data contract, so results are right only with exactly these."""

# Committer name of commits that the hosting service makes itself.
SERVICE_COMMITTER = "GitHub"

# Login shown for a commit whose author has no account.
PLACEHOLDER_LOGIN = "invalid-email-address"

# Organization and type of a repository without one.
NOT_KNOWN = "not known"

# Form of the dates in the mined commit log.
DATE_PATTERN = "yyyy-MM-dd HH:mm:ss"

# Columns of the mined tables: new names, and columns the commits table does not keep.
COMMIT_RENAMES = {"hash": "commit_sha", "committer_date": "commited_at", "parents": "parent_sha"}
COMMIT_DROPS = (
    "author_email", "author_name", "committer_email", "author_date", "author_timezone", "commit_message_len",
    "project_name", "merge",
)
EDIT_RENAMES = {"commit_hash": "commit_sha"}

# Community files whose first appearance is reported, by the column that reports it.
COMMUNITY_FILES = {
    "file_readme": "README.md",
    "file_code_of_conduct": "CODE_OF_CONDUCT.md",
    "file_contributing": "CONTRIBUTING.md",
    "file_funding": "FUNDING.yml",
    "file_IssuePR_templates": ".github/ISSUE_TEMPLATE/config.yml",
    "file_security": "SECURITY.md",
    "file_support": "SUPPORT.md",
}

# Names that tell the parents of reactions apart.
REACTION_PARENTS = ("issue", "comment", "review_comment")
