"""Issue-tracker queries. The JSON is built from the given tables, the expected result is not."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.feeds import query
from tidemill.plans import forge

ISO = "\"yyyy-MM-dd'T'HH:mm:ss'Z'\""

_TICKET = f"""
    '{{"id":', o_orderkey, ',"number":', o_custkey, ',"title":"Order ', o_orderkey, '","state":"', lower(o_orderstatus),
    '","url":"https://api.example.com/', o_orderkey, '","html_url":"https://example.com/', o_orderkey,
    '","created_at":"', date_format(o_orderdate, {ISO}), '","updated_at":"', date_format(o_orderdate, {ISO}), '"',
    CASE o_orderstatus WHEN 'F' THEN concat(',"closed_at":"', date_format(o_orderdate, {ISO}), '","body":"done"')
                       WHEN 'O' THEN ',"closed_at":null,"body":null' ELSE '' END,
    CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE concat(',"comments":', length(o_orderpriority)) END,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN ''
         ELSE concat(',"labels":[{{"name":"', substr(o_orderpriority, 1, 1), '"}},{{"name":"', o_orderpriority, '"}}]') END,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE concat(',"assignees":[{{"login":"c', o_custkey, '"}}]') END,
    CASE WHEN o_orderpriority = '1-URGENT' THEN ',"milestone":{{"title":"now"}}'
         WHEN o_orderpriority = '2-HIGH' THEN ',"milestone":null' ELSE '' END,
    CASE WHEN o_orderstatus <> 'O' THEN concat(',"user":{{"login":"u', o_custkey, '"}}') ELSE '' END
"""

ISSUES = f"""
    SELECT concat({_TICKET}, CASE o_orderstatus WHEN 'F' THEN ',"pull_request":{{}}' WHEN 'O' THEN ',"pull_request":null'
                                                ELSE '' END, '}}') AS raw
    FROM {{orders}}
"""

PULLS = f"""
    SELECT concat({_TICKET},
        CASE o_orderstatus WHEN 'F' THEN concat(',"merged":true,"merged_at":"', date_format(o_orderdate, {ISO}), '"')
                           WHEN 'O' THEN ',"merged":null,"draft":true,"review_comments":7' ELSE '' END,
        CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE ',"base":{{"ref":"main"}},"head":{{"ref":"topic"}}' END, '}}') AS raw
    FROM {{orders}}
"""

COMMITS = f"""
    SELECT concat('{{"sha":"', md5(concat(l_orderkey, '/', l_linenumber, '/', l_partkey, '/', l_suppkey)),
        '","url":"https://api.example.com/c/', l_orderkey, '"',
        CASE WHEN l_returnflag = 'N' THEN ''
             ELSE concat(',"commit":{{',
                         CASE WHEN l_returnflag = 'A' THEN concat('"message":"line ', l_linenumber, '",') ELSE '' END,
                         '"author":{{"name":"a', l_suppkey, '","email":null,"date":"', date_format(l_shipdate, {ISO}),
                         '"}},"committer":{{"name":"web","date":"', CASE WHEN l_linestatus = 'O' THEN 'never' ELSE '' END, '"}}}}') END,
        CASE WHEN l_linestatus = 'O' THEN concat(',"author":{{"login":"s', l_suppkey, '"}},"committer":null') ELSE '' END,
        CASE WHEN l_linestatus = 'F' THEN concat(',"parents":[{{"sha":"', md5(CAST(l_orderkey AS STRING)), '"}}],"stats":{{"total":',
                                                 l_linenumber, '}}') ELSE '' END,
        '}}') AS raw
    FROM {{lineitem}}
"""

REPOSITORIES = """
    SELECT concat('{"id":', p_partkey, ',"name":"', p_name, '","full_name":"', p_brand, '/', p_name,
        '","url":"https://api.example.com/r/', p_partkey, '","html_url":"https://example.com/r/', p_partkey,
        '","created_at":"2001-02-03T04:05:06Z","updated_at":"2001-02-03T04:05:06+02:00"',
        CASE p_type WHEN 'PROMO' THEN ',"description":null,"pushed_at":"2001-02-04T00:00:00Z","fork":true'
                    WHEN 'SMALL' THEN concat(',"description":"', p_brand, '","homepage":"h","language":"SQL"')
                    WHEN 'LARGE' THEN ',"visibility":"private","default_branch":"trunk","archived":true,"disabled":true'
                    ELSE '' END,
        CASE WHEN p_size > 25 THEN concat(',"forks_count":', p_size, ',"stargazers_count":', p_size + 1, ',"topics":["x","', p_type, '"]')
             ELSE '' END,
        CASE WHEN p_size > 10 THEN concat(',"watchers_count":', p_size, ',"open_issues_count":null,"owner":{"login":"', p_brand, '"}')
             ELSE '' END, '}') AS raw
    FROM {part}
"""

USERS = """
    SELECT concat('{"id":', c_custkey, ',"login":"', c_name, '","url":"https://api.example.com/u/', c_custkey,
        '","html_url":"https://example.com/u/', c_custkey, '"',
        CASE c_mktsegment WHEN 'BUILDING' THEN ',"type":"Organization","name":"B","company":"C","blog":"","site_admin":true'
                          WHEN 'MACHINERY' THEN ',"type":null,"email":"m@example.com","bio":null,"location":"L"'
                          ELSE '' END,
        CASE WHEN c_acctbal > 0 THEN concat(',"public_repos":', c_nationkey, ',"followers":', c_custkey,
                                            ',"created_at":"2001-01-01T00:00:00Z","updated_at":"bad"') ELSE '' END,
        '}') AS raw
    FROM {customer}
"""

TEAMS = """
    SELECT concat('{"id":', s_suppkey, ',"url":"https://api.example.com/t/', s_suppkey, '","created_at":"2001-01-01T00:00:00Z"',
        CASE WHEN s_acctbal > 5000 THEN concat(',"nation":', s_nationkey, ',"tags":["a",1]') ELSE '' END, '}') AS raw
    FROM {supplier}
"""


def _lists_as_text(df: DataFrame) -> DataFrame:
    """Lists joined to text, so that any comparison of values can handle them."""
    return df.withColumns({c: F.array_join(c, "|") for c, t in df.dtypes if t == "array<string>"})


def _flat(spark: SparkSession, folder: str, sql: str, endpoint: str) -> DataFrame:
    return _lists_as_text(forge.transform_text(query(spark, folder, sql), endpoint))


def commits(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(spark, folder, COMMITS, "commits").withColumn("stats", F.to_json("stats"))


def teams(spark: SparkSession, folder: str) -> DataFrame:
    rows = forge.transform_text(query(spark, folder, TEAMS), "teams")
    return rows.withColumns({"id": F.col("id").cast("long"), "extras": F.to_json("extras")})


def generic(spark: SparkSession, folder: str) -> DataFrame:
    rows = query(spark, folder, "SELECT s_suppkey AS id, s_name AS url, '2001-01-01T00:00:00Z' AS created_at, s_acctbal FROM {supplier}")
    return forge.transform(rows, "teams")


QUERIES = {
    "gh_issues": lambda spark, folder: _flat(spark, folder, ISSUES, "issues"),
    "gh_pulls": lambda spark, folder: _flat(spark, folder, PULLS, "pulls"),
    "gh_commits": commits,
    "gh_repos": lambda spark, folder: _flat(spark, folder, REPOSITORIES, "repositories"),
    "gh_users": lambda spark, folder: _flat(spark, folder, USERS, "users"),
    "gh_generic": generic,
    "gh_generic_open": teams,
}

_TICKET_COLUMNS = """
    o_orderkey AS id, 'Order ' || o_orderkey AS title, lower(o_orderstatus) AS state,
    'https://api.example.com/' || o_orderkey AS api_url, 'https://example.com/' || o_orderkey AS html_url,
    o_orderdate AS created_at, o_orderdate AS updated_at, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS closed_at,
    CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN NULL ELSE '' END AS body,
    CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE length(o_orderpriority) END AS comments_count,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN '' ELSE o_orderpriority[1] || '|' || o_orderpriority END AS labels,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'c' || o_custkey END AS assignees,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'now' END AS milestone,
    CASE WHEN o_orderstatus <> 'O' THEN 'u' || o_custkey END AS author
"""

ORACLES = {
    "gh_issues": f"SELECT {_TICKET_COLUMNS}, o_custkey AS issue_number, o_orderstatus IN ('F', 'O') AS is_pull_request FROM orders",
    "gh_pulls": f"""
        SELECT {_TICKET_COLUMNS}, o_custkey AS pr_number, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS merged_at,
               CASE WHEN o_orderstatus = 'O' THEN 7::BIGINT ELSE 0 END AS review_comments_count, o_orderstatus = 'O' AS is_draft,
               CASE o_orderstatus WHEN 'F' THEN true WHEN 'P' THEN false END AS is_merged,
               CASE WHEN o_orderpriority <> '5-LOW' THEN 'main' END AS base_branch,
               CASE WHEN o_orderpriority <> '5-LOW' THEN 'topic' END AS head_branch
        FROM orders
    """,
    "gh_commits": """
        SELECT md5(l_orderkey || '/' || l_linenumber || '/' || l_partkey || '/' || l_suppkey) AS sha,
               'https://api.example.com/c/' || l_orderkey AS api_url, NULL::VARCHAR AS html_url,
               CASE WHEN l_returnflag = 'A' THEN 'line ' || l_linenumber ELSE '' END AS message,
               CASE WHEN l_returnflag <> 'N' THEN 'a' || l_suppkey END AS author_name, NULL::VARCHAR AS author_email,
               CASE WHEN l_returnflag <> 'N' THEN l_shipdate END AS author_date,
               CASE WHEN l_returnflag <> 'N' THEN 'web' END AS committer_name, NULL::VARCHAR AS committer_email,
               NULL::TIMESTAMP AS committer_date, CASE WHEN l_linestatus = 'O' THEN 's' || l_suppkey END AS github_author,
               NULL::VARCHAR AS github_committer,
               CASE WHEN l_linestatus = 'F' THEN md5(l_orderkey::VARCHAR) ELSE '' END AS parents,
               CASE WHEN l_linestatus = 'F' THEN '{"total":' || l_linenumber || '}' ELSE '{}' END AS stats
        FROM lineitem
    """,
    "gh_repos": """
        SELECT p_partkey AS id, p_name AS name, p_brand || '/' || p_name AS full_name,
               'https://api.example.com/r/' || p_partkey AS api_url, 'https://example.com/r/' || p_partkey AS html_url,
               CASE p_type WHEN 'PROMO' THEN NULL WHEN 'SMALL' THEN p_brand ELSE '' END AS description,
               TIMESTAMP '2001-02-03 04:05:06' AS created_at, TIMESTAMP '2001-02-03 02:05:06' AS updated_at,
               CASE WHEN p_type = 'PROMO' THEN TIMESTAMP '2001-02-04' END AS pushed_at,
               CASE WHEN p_type = 'SMALL' THEN 'h' END AS homepage, CASE WHEN p_type = 'SMALL' THEN 'SQL' END AS language,
               p_type = 'PROMO' AS fork, CASE WHEN p_size > 25 THEN p_size ELSE 0 END::BIGINT AS forks_count,
               CASE WHEN p_size > 25 THEN p_size + 1 ELSE 0 END::BIGINT AS stargazers_count,
               CASE WHEN p_size > 10 THEN p_size ELSE 0 END::BIGINT AS watchers_count,
               CASE WHEN p_size > 10 THEN NULL ELSE 0 END::BIGINT AS open_issues_count,
               CASE WHEN p_size > 25 THEN 'x|' || p_type ELSE '' END AS topics,
               CASE WHEN p_type = 'LARGE' THEN 'private' ELSE 'public' END AS visibility,
               CASE WHEN p_type = 'LARGE' THEN 'trunk' ELSE 'main' END AS default_branch,
               CASE WHEN p_size > 10 THEN p_brand END AS owner, p_type = 'LARGE' AS is_archived, p_type = 'LARGE' AS is_disabled
        FROM part
    """,
    "gh_users": """
        SELECT c_custkey AS id, c_name AS login, 'https://api.example.com/u/' || c_custkey AS api_url,
               'https://example.com/u/' || c_custkey AS html_url,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Organization' WHEN 'MACHINERY' THEN NULL ELSE 'User' END AS type,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'B' END AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'C' END AS company,
               CASE WHEN c_mktsegment = 'BUILDING' THEN '' END AS blog, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'L' END AS location,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'm@example.com' END AS email, NULL::VARCHAR AS bio,
               NULL::VARCHAR AS twitter_username, CASE WHEN c_acctbal > 0 THEN c_nationkey ELSE 0 END::BIGINT AS public_repos,
               0::BIGINT AS public_gists, CASE WHEN c_acctbal > 0 THEN c_custkey ELSE 0 END AS followers, 0::BIGINT AS following,
               CASE WHEN c_acctbal > 0 THEN TIMESTAMP '2001-01-01' END AS created_at, NULL::TIMESTAMP AS updated_at,
               c_mktsegment = 'BUILDING' AS is_site_admin
        FROM customer
    """,
    "gh_generic": """
        SELECT s_suppkey AS id, s_name AS url, s_name AS api_url, TIMESTAMP '2001-01-01' AS created_at, s_acctbal FROM supplier
    """,
    "gh_generic_open": """
        SELECT s_suppkey AS id, 'https://api.example.com/t/' || s_suppkey AS api_url, NULL::VARCHAR AS html_url,
               TIMESTAMP '2001-01-01' AS created_at, NULL::TIMESTAMP AS updated_at,
               '{"url":"https://api.example.com/t/' || s_suppkey || '"'
               || CASE WHEN s_acctbal > 5000 THEN ',"nation":' || s_nationkey || ',"tags":["a",1]' ELSE '' END || '}' AS extras
        FROM supplier
    """,
}
