"""The declared data tests, model by model."""

from __future__ import annotations

from forgemeter.operators.checks import Rule


def _rules(model: str, not_null: tuple[str, ...], unique: tuple[str, ...] = (), accepted: dict | None = None) -> list[Rule]:
    return [
        *[Rule(model, c, "not_null") for c in not_null],
        *[Rule(model, c, "unique") for c in unique],
        *[Rule(model, c, "accepted_values", tuple(v)) for c, v in (accepted or {}).items()],
    ]


# Which column carries which test, and the accepted words.
REVIEW_STATES = ["open", "closed"]
STREAK_STATES = ["active", "ended"]
REVIEW_OUTCOMES = ["merged", "closed_not_merged", "open"]

CONTRIBUTION_RULES = [
    *_rules("contrib_staged", ("username", "date", "contribution_count")),
    *_rules("contrib_patterns", ("username",)),
    *_rules("contrib_leaderboard", ("username", "total_contributions"), unique=("username",)),
    *_rules("contrib_monthly", ("username", "month_start", "total_contributions")),
    *_rules("contrib_recent", ("username", "date", "contribution_count")),
    *_rules(
        "contrib_streaks",
        ("username", "streak_start", "streak_end", "streak_length_days"),
        accepted={"streak_status": STREAK_STATES},
    ),
    *_rules("contrib_trends", ("username", "month_start", "monthly_contributions")),
    *_rules("contrib_user_summary", ("username", "total_contributions"), unique=("username",)),
    *_rules("contrib_weekly", ("username", "week_start", "total_contributions")),
]

PULL_RULES = [
    *_rules(
        "pulls_staged", ("repo_name", "pr_id", "state", "created_at", "user_login"), accepted={"state": REVIEW_STATES}
    ),
    *_rules("pulls_patterns", ("user_login",)),
    *_rules("pulls_leaderboard", ("user_login",), unique=("user_login",)),
    *_rules("pulls_monthly", ("month_start", "total_pulls")),
    *_rules("pulls_recent", ("user_login", "repo_name", "pr_id", "state", "created_at")),
    *_rules("pulls_repo_summary", ("repo_name", "total_pulls"), unique=("repo_name",)),
    *_rules(
        "pulls_time_to_merge",
        ("user_login", "repo_name", "pr_id", "state", "created_at"),
        accepted={"state": REVIEW_STATES, "pr_status": REVIEW_OUTCOMES},
    ),
    *_rules("pulls_trends", ("month_start", "monthly_pulls")),
    *_rules("pulls_user_summary", ("user_login", "total_pulls"), unique=("user_login",)),
    *_rules("pulls_weekly", ("week_start", "total_pulls")),
]

# Declared on the raw table, which is no model: part of a run only on request.
SOURCE_RULES = [
    Rule("raw_pulls", "pr_id", "unique", on_source=True),
    Rule("raw_pulls", "pr_id", "not_null", on_source=True),
]

ALL_RULES = [*CONTRIBUTION_RULES, *PULL_RULES, *SOURCE_RULES]
