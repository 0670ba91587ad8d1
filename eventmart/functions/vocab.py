"""Patterns, thresholds and labels that results must agree on."""

from __future__ import annotations

# ---- fixed values: regular expressions -------------------------------------------------
AI_TOPIC_PATTERN = (
    "ai|ml|llm|gpt|deep.learning|machine.learning|neural|transformer|diffusion|langchain"
)
BOT_PATTERN = r"\[bot\]|bot$|github.actions"
DEFAULT_BRANCH_PATTERN = r"refs/heads/(main|master)$"
BATCH_DATE_PATTERN = r"(\d{4})-\d{2}-\d{2}"

# ---- fixed values: named period ---------------------------------------------------------
COVID_PERIOD = ("is_covid_period", "2020-03-01", "2021-06-30")
COVID_YEARS = (2019, 2020, 2021)

# ---- fixed values: defaults -------------------------------------------------------------
UNKNOWN_LANGUAGE = "Unknown"
EARLIEST_EVENT = "2008-01-01"

# ---- fixed values: thresholds, first match wins -----------------------------------------
PR_SIZES = ((10, "XS"), (50, "S"), (250, "M"), (1000, "L"))
PR_SIZE_ABOVE = "XL"
CONFIDENCE_TIERS = (
    (0.80, "Very High Risk (80%+)"),
    (0.60, "High Risk (60-80%)"),
    (0.40, "Moderate Risk (40-60%)"),
    (0.20, "Low Risk (20-40%)"),
)
CONFIDENCE_BELOW = "Very Low Risk (<20%)"
MOMENTUM_LABELS = ((1.5, "Accelerating"), (0.5, "Stable"), (0.1, "Declining"))
MOMENTUM_BELOW = "Stalled"
TREND_LABELS = (
    (0.5, "Strongly Growing"),
    (0.1, "Growing"),
    (-0.1, "Stable"),
    (-0.5, "Declining"),
)
TREND_BELOW = "Strongly Declining"
CLUSTER_LABELS = ("Viral", "Established", "Stable", "Declining", "Dormant", "Inactive")

HIGH_RISK, MODERATE_RISK, LOW_RISK, TOO_YOUNG = (
    "High Risk",
    "Moderate Risk",
    "Low Risk",
    "Too Young",
)
MIN_AGE_DAYS = 730
EARLY_WINDOW_DAYS = 90

# ---- fixed values: language attributes (name, paradigm, type system, year, emerging) ----
KNOWN_LANGUAGES = (
    ("Python", "multi-paradigm", "dynamic", 1991, False),
    ("JavaScript", "multi-paradigm", "dynamic", 1995, False),
    ("TypeScript", "multi-paradigm", "static", 2012, False),
    ("Java", "OOP", "static", 1995, False),
    ("Go", "procedural", "static", 2009, False),
    ("Rust", "systems", "static", 2015, True),
    ("C++", "multi-paradigm", "static", 1985, False),
    ("C", "procedural", "static", 1972, False),
    ("Ruby", "OOP", "dynamic", 1995, False),
    ("PHP", "multi-paradigm", "dynamic", 1994, False),
    ("Swift", "multi-paradigm", "static", 2014, False),
    ("Kotlin", "multi-paradigm", "static", 2011, False),
    ("Scala", "functional", "static", 2004, False),
    ("Shell", "scripting", "dynamic", 1989, False),
    ("Jupyter Notebook", "scripting", "dynamic", 2014, False),
    ("Unknown", "unknown", "unknown", None, False),
)

# ---- fixed values: model inputs, in vector order ----------------------------------------
NUMERIC_FEATURES = (
    "early_commits",
    "early_pushes",
    "early_stars",
    "early_forks",
    "early_prs_opened",
    "early_prs_merged",
    "early_issues",
    "avg_daily_contributors",
    "active_days_in_90",
    "unique_branches",
    "default_branch_push_ratio",
    "avg_pr_additions",
    "avg_review_comments",
    "total_unique_contributors",
    "pr_merge_rate",
    "fork_to_star_ratio",
    "commits_per_active_day",
    "repo_age_days",
    "created_year",
    "commit_momentum",
    "avg_commits_early",
    "avg_commits_recent",
    "years_observed",
    "total_active_days",
)
FLAG_FEATURES = ("is_ai_ml_repo", "has_readme", "has_ci")
CATEGORY_FEATURES = ("language", "license")
