"""Issue-tracker and code-host records: nested JSON to flat tables.

Records come parsed with the schemas below, from files with ``read_records`` or from a JSON text
column with ``parse_records``. Fields whose absence has its own meaning are VARIANT there. A record
that lacks a required key fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.dates import parse_timestamp, timestamp_column
from tidemill.functions.jsons import default_if_absent, parse_records, present, require_keys, without_keys
from tidemill.operators.rows import SEQ
from tidemill.sources.files import read_json_documents
from tidemill.sources.pages import read_json_pages

_LINKED = "id variant, number variant, title variant, state variant, url variant, html_url variant"
_TIMES = "created_at variant, updated_at variant"
_PEOPLE = (
    "labels array<struct<name:string>>, assignees array<struct<login:string>>, "
    "milestone struct<title:string>, user struct<login:string>"
)
_SIGNATURE = "struct<name:string, email:string, date:string>"

SCHEMAS = {
    "issues": f"{_LINKED}, {_TIMES}, closed_at string, body variant, comments variant, pull_request variant, {_PEOPLE}",
    "pulls": (
        f"{_LINKED}, {_TIMES}, closed_at string, merged_at string, body variant, comments variant, "
        f"review_comments variant, {_PEOPLE}, draft variant, merged variant, base struct<ref:string>, "
        "head struct<ref:string>"
    ),
    "commits": (
        "sha variant, url variant, html_url string, "
        f"commit struct<message:variant, author:{_SIGNATURE}, committer:{_SIGNATURE}>, "
        "author struct<login:string>, committer struct<login:string>, parents array<struct<sha:string>>, stats variant"
    ),
    "repositories": (
        "id variant, name variant, full_name variant, url variant, html_url variant, description variant, "
        f"{_TIMES}, pushed_at string, homepage string, language string, fork variant, forks_count variant, "
        "stargazers_count variant, watchers_count variant, open_issues_count variant, topics variant, "
        "visibility variant, default_branch variant, owner struct<login:string>, archived variant, disabled variant"
    ),
    "users": (
        "id variant, login variant, url variant, html_url variant, type variant, name string, company string, "
        "blog string, location string, email string, bio string, twitter_username string, public_repos variant, "
        f"public_gists variant, followers variant, following variant, {_TIMES}, site_admin variant"
    ),
}

REQUIRED = {
    "issues": ["id", "number", "title", "state", "url", "html_url", "created_at", "updated_at"],
    "pulls": ["id", "number", "title", "state", "url", "html_url", "created_at", "updated_at"],
    "commits": ["sha", "url"],
    "repositories": ["id", "name", "full_name", "url", "html_url", "created_at", "updated_at"],
    "users": ["id", "login", "url", "html_url"],
}


def read_records(spark: SparkSession, path: str | list[str], endpoint: str, split: bool = False) -> DataFrame:
    """Records of JSON files that hold one object or an array of objects; with ``split``, big files by many tasks."""
    if split:
        return read_json_pages(spark, path, SCHEMAS[endpoint]).drop(SEQ)
    return read_json_documents(spark, path, SCHEMAS.get(endpoint))


def _as(dtype: str, field: str, name: str | None = None) -> Column:
    return F.col(field).cast(dtype).alias(name or field)


def _text(field: str, name: str | None = None) -> Column:
    return _as("string", field, name)


def _moment(field: str, name: str | None = None) -> Column:
    return parse_timestamp(F.col(field).cast("string")).alias(name or field)


def _count(field: str, name: str | None = None) -> Column:
    return default_if_absent(F.col(field), "long", F.lit(0)).alias(name or field)


def _flag(field: str, name: str | None = None) -> Column:
    return default_if_absent(F.col(field), "boolean", F.lit(False)).alias(name or field)


def _text_or(field: str, default: str) -> Column:
    return default_if_absent(F.col(field), "string", F.lit(default)).alias(field)


def _list(items: Column, name: str) -> Column:
    return F.coalesce(items, F.array().cast("array<string>")).alias(name)


def _ticket(number_name: str) -> list[Column]:
    """Columns that issues and pull requests share."""
    return [
        _as("long", "id"),
        _as("long", "number", number_name),
        _text("title"),
        _text("state"),
        _text("url", "api_url"),
        _text("html_url"),
        _moment("created_at"),
        _moment("updated_at"),
        _moment("closed_at"),
        _text_or("body", ""),
        _count("comments", "comments_count"),
        _list(F.col("labels.name"), "labels"),
        _list(F.col("assignees.login"), "assignees"),
        F.col("milestone.title").alias("milestone"),
        F.col("user.login").alias("author"),
    ]


def issues(df: DataFrame) -> DataFrame:
    return df.select(*_ticket("issue_number"), present(F.col("pull_request")).alias("is_pull_request"))


def pulls(df: DataFrame) -> DataFrame:
    return df.select(
        *_ticket("pr_number"),
        _moment("merged_at"),
        _count("review_comments", "review_comments_count"),
        _flag("draft", "is_draft"),
        _flag("merged", "is_merged"),
        F.col("base.ref").alias("base_branch"),
        F.col("head.ref").alias("head_branch"),
    )


def commits(df: DataFrame) -> DataFrame:
    signed = [
        column
        for role in ("author", "committer")
        for column in (
            F.col(f"commit.{role}.name").alias(f"{role}_name"),
            F.col(f"commit.{role}.email").alias(f"{role}_email"),
            _moment(f"commit.{role}.date", f"{role}_date"),
        )
    ]
    return df.select(
        _text("sha"),
        _text("url", "api_url"),
        F.col("html_url"),
        default_if_absent(F.col("commit.message"), "string", F.lit("")).alias("message"),
        *signed,
        F.col("author.login").alias("github_author"),
        F.col("committer.login").alias("github_committer"),
        _list(F.col("parents.sha"), "parents"),
        F.when(present(F.col("stats")), F.col("stats")).otherwise(F.parse_json(F.lit("{}"))).alias("stats"),
    )


def repositories(df: DataFrame) -> DataFrame:
    return df.select(
        _as("long", "id"),
        _text("name"),
        _text("full_name"),
        _text("url", "api_url"),
        _text("html_url"),
        _text_or("description", ""),
        _moment("created_at"),
        _moment("updated_at"),
        _moment("pushed_at"),
        F.col("homepage"),
        F.col("language"),
        _flag("fork"),
        *[_count(f"{what}_count") for what in ("forks", "stargazers", "watchers", "open_issues")],
        default_if_absent(F.col("topics"), "array<string>", F.array()).alias("topics"),
        _text_or("visibility", "public"),
        _text_or("default_branch", "main"),
        F.col("owner.login").alias("owner"),
        _flag("archived", "is_archived"),
        _flag("disabled", "is_disabled"),
    )


def users(df: DataFrame) -> DataFrame:
    passed = ("name", "company", "blog", "location", "email", "bio", "twitter_username")
    return df.select(
        _as("long", "id"),
        _text("login"),
        _text("url", "api_url"),
        _text("html_url"),
        _text_or("type", "User"),
        *[F.col(c) for c in passed],
        *[_count(c) for c in ("public_repos", "public_gists", "followers", "following")],
        _moment("created_at"),
        _moment("updated_at"),
        _flag("site_admin", "is_site_admin"),
    )


def generic(df: DataFrame) -> DataFrame:
    """Any other record: ``url`` also as ``api_url``, the two dates parsed, all else unchanged."""
    changes = {c: timestamp_column(df, c) for c in ("created_at", "updated_at") if c in df.columns}
    if "url" in df.columns:
        changes["api_url"] = F.col("url")
    return df.withColumns(changes)


def generic_open(df: DataFrame, raw: str = "raw") -> DataFrame:
    """``generic`` for JSON text of unknown schema; the other fields end in the map ``extras``."""
    known = f"id variant, url string, html_url string, {_TIMES}"
    others = without_keys(F.col("_raw"), ["id", "html_url", "created_at", "updated_at"]).alias("extras")
    return parse_records(df.select(F.col(raw).alias("_raw")), "_raw", known, keep=["_raw"]).select(
        "id", _text("url", "api_url"), _text("html_url"), _moment("created_at"), _moment("updated_at"), others
    )


TRANSFORMS = {"issues": issues, "pulls": pulls, "commits": commits, "repositories": repositories, "users": users}


def transform(df: DataFrame, endpoint: str = "issues", strict: bool = True) -> DataFrame:
    """Flatten parsed records of an endpoint; unknown endpoints get the generic form.

    ``strict=False`` lets records without a required key through, with nulls.
    """
    if endpoint not in TRANSFORMS:
        return generic(df)
    return TRANSFORMS[endpoint](require_keys(df, REQUIRED[endpoint]) if strict else df)


def transform_text(df: DataFrame, endpoint: str = "issues", raw: str = "raw", strict: bool = True) -> DataFrame:
    """``transform`` for a JSON text column."""
    if endpoint not in TRANSFORMS:
        return generic_open(df, raw)
    return transform(parse_records(df, raw, SCHEMAS[endpoint]), endpoint, strict)
