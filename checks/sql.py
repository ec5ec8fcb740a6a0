"""DuckDB statements that state the expected results by brute force on the same tables."""

from __future__ import annotations

import re

from marquee.functions.text import STOP_WORDS

_STOP_LIST = ", ".join(f"'{word}'" for word in STOP_WORDS)


def _case(column: str, table: dict[str, str], other: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in table.items())
    return f"CASE {column} {whens} ELSE {other} END"


_TRAIN = _case("event_type", {
    "impression": "0.2", "click": "0.5", "play_start": "1.0", "watch_progress": "1.5", "complete": "2.2",
    "watchlist_add": "0.8"}, "0.1")
_ONLINE = _case("event_type", {
    "impression": "0.1", "click": "0.3", "play_start": "0.8", "watch_progress": "1.2", "complete": "2.0",
    "watchlist_add": "0.5"}, "0.1")


def _level(column: str, other: int) -> str:
    return _case(column, {"G": "0", "PG": "1", "PG-13": "2", "R": "3"}, str(other))


def _tfidf(prefix: str, corpus: str) -> dict[str, str]:
    p = prefix
    return {
        f"{p}_tok": f"""SELECT item_id, term FROM (SELECT item_id,
            unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM {corpus})
            WHERE term NOT IN ({{STOP}})""",
        f"{p}_tf": f"SELECT item_id, term, count(*) AS tf FROM {p}_tok GROUP BY 1, 2",
        f"{p}_df": f"SELECT term, count(*) AS df FROM {p}_tf GROUP BY 1",
        f"{p}_raw": f"""SELECT item_id, term, tf, df,
            tf * (ln(CAST(1 + (SELECT count(*) FROM {corpus}) AS DOUBLE) / CAST(1 + df AS DOUBLE)) + 1) AS raw
            FROM {p}_tf JOIN {p}_df USING (term)""",
        f"{p}_w": f"""SELECT item_id, term, tf, df,
            raw / sqrt(sum(raw * raw) OVER (PARTITION BY item_id)) AS weight FROM {p}_raw""",
        f"{p}_sim": f"""SELECT a.item_id AS source_item_id, b.item_id AS neighbor_item_id,
            round(sum(a.weight * b.weight), 6) AS score
            FROM {p}_w a JOIN {p}_w b USING (term) WHERE a.item_id <> b.item_id GROUP BY 1, 2""",
        f"{p}_top": f"""SELECT source_item_id, neighbor_item_id, score FROM {p}_sim WHERE score > 0
            QUALIFY row_number() OVER (PARTITION BY source_item_id ORDER BY score DESC, neighbor_item_id) <= 8""",
        f"{p}_filled": f"""SELECT a.item_id AS source_item_id, b.item_id AS neighbor_item_id,
            coalesce(s.score, 0.0) AS score, 'content' AS algorithm
            FROM {corpus} a JOIN {corpus} b ON a.item_id <> b.item_id
            LEFT JOIN {p}_sim s ON s.source_item_id = a.item_id AND s.neighbor_item_id = b.item_id
            QUALIFY row_number() OVER (PARTITION BY a.item_id ORDER BY coalesce(s.score, 0.0) DESC, b.item_id) <= 8""",
    }


def _covisit(prefix: str, visits: str) -> dict[str, str]:
    p = prefix
    return {
        f"{p}_n": f"SELECT item_id, count(*) AS users FROM {visits} GROUP BY 1",
        f"{p}_pairs": f"""SELECT a.item_id AS s, b.item_id AS t, count(*) AS shared_users
            FROM {visits} a JOIN {visits} b ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY 1, 2""",
        f"{p}_edges": f"""SELECT s AS source_item_id, t AS neighbor_item_id, shared_users,
            x.users AS source_users, y.users AS neighbor_users,
            round(shared_users / sqrt(CAST(x.users * y.users AS DOUBLE)), 6) AS score
            FROM {p}_pairs JOIN {p}_n x ON x.item_id = s JOIN {p}_n y ON y.item_id = t
            QUALIFY row_number() OVER (PARTITION BY s
                ORDER BY CAST(shared_users * shared_users AS DOUBLE) / y.users DESC, t) <= 8""",
    }


CTES: dict[str, str] = {
    "items": """SELECT 'm' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS item_id, p_name AS title,
        CASE WHEN p_partkey % 2 = 0 THEN 'movie' ELSE 'series' END AS item_type,
        split_part(p_name, ' ', 2) || ', ' || lower(p_type) AS genres, '' AS actors, p_brand AS director,
        p_name || ' in ' || lower(p_type) || ' size ' || CAST(p_size AS VARCHAR) AS synopsis, 'en' AS language,
        CAST(2018 + p_size % 10 AS INTEGER) AS release_year,
        CASE p_size % 4 WHEN 0 THEN 'G' WHEN 1 THEN 'PG' WHEN 2 THEN 'PG-13' ELSE 'R' END AS maturity_rating,
        CASE WHEN p_partkey % 5 = 0 THEN 'EUROPE,ASIA' WHEN p_partkey % 7 = 0 THEN 'AMERICA'
             ELSE 'GLOBAL,AFRICA' END AS available_regions,
        p_partkey % 17 <> 0 AS is_active FROM part""",
    "people": """SELECT c_custkey, r_name, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "users": """SELECT 'u' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS user_id, r_name AS region,
        'en' AS preferred_language, CASE c_custkey % 5 WHEN 0 THEN 'G' WHEN 1 THEN 'PG' WHEN 2 THEN 'PG-13'
        WHEN 3 THEN 'R' ELSE 'NR' END AS maturity_rating FROM people""",
    "inter": """SELECT CAST(event_id AS VARCHAR) AS event_id,
        'u' || lpad(CAST(user_id AS VARCHAR), 10, '0') AS user_id,
        CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 5 THEN 'x' ELSE 'm' END
            || lpad(json_extract_string(props, '$.k'), 10, '0') AS item_id,
        CASE WHEN event_type = 'error' THEN 'impression' WHEN event_type = 'click' THEN 'click'
             WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'play_start'
             WHEN event_type = 'view' THEN 'watch_progress' WHEN event_type = 'purchase' THEN 'complete'
             ELSE 'watchlist_add' END AS event_type,
        CAST(floor(value * 4) AS INTEGER) AS watch_seconds,
        CAST(least(CAST(value AS DECIMAL(12,2)) * 0.1, 100.0) AS DOUBLE) AS completion_pct, r_name AS region,
        CASE event_id % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' ELSE 'tv' END AS device_type, ts AS event_ts
        FROM events JOIN people ON c_custkey = user_id""",
    "as_of": "SELECT max(event_ts) AS t FROM inter",
    "weighted": f"""SELECT *, CAST(CAST({_TRAIN} AS DECIMAL(18,6))
        + CAST(completion_pct AS DECIMAL(12,4)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,6)) AS weight,
        CAST({_ONLINE} AS DECIMAL(18,6)) AS increment,
        event_type IN ('play_start', 'watch_progress', 'complete')
            AND (completion_pct >= 5.0 OR watch_seconds >= 120 OR event_type = 'complete') AS is_watched
        FROM inter""",
    "known": "SELECT * FROM weighted WHERE item_id IN (SELECT item_id FROM items)",
    "engaged": """SELECT * FROM inter
        WHERE event_type IN ('play_start', 'watch_progress', 'complete', 'watchlist_add', 'click')""",
    "visits": "SELECT DISTINCT user_id, item_id FROM engaged",
    "baskets": """SELECT DISTINCT 'u' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS user_id,
        'm' || lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS item_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    **_covisit("cv", "visits"),
    **_covisit("bk", "baskets"),
    "corpus": """SELECT item_id, title || ' ' || replace(genres, ',', ' ') || ' ' || actors || ' ' || director
        || ' ' || synopsis AS text FROM items WHERE is_active""",
    "docs": "SELECT 'd' || lpad(CAST(doc_id AS VARCHAR), 10, '0') AS item_id, text FROM documents",
    **_tfidf("it", "corpus"),
    **_tfidf("dc", "docs"),
    "neighbors": """SELECT source_item_id, neighbor_item_id, score, 'collaborative' AS algorithm FROM cv_edges
        UNION ALL SELECT source_item_id, neighbor_item_id, score, algorithm FROM it_filled""",
    "trend_sums": """SELECT region, item_id, sum(weight) AS weight FROM weighted
        WHERE event_ts >= (SELECT t FROM as_of) - INTERVAL 24 HOUR GROUP BY 1, 2""",
    "trending": """SELECT region, item_id, round(CAST(weight AS DOUBLE), 6) AS score FROM trend_sums
        QUALIFY row_number() OVER (PARTITION BY region ORDER BY weight DESC, item_id) <= 10""",
    "seen": "SELECT user_id, item_id, max(event_ts) AS last_ts FROM known GROUP BY 1, 2",
    "recent": """SELECT user_id, item_id, last_ts, row_number() OVER (PARTITION BY user_id
        ORDER BY last_ts DESC, item_id DESC) AS position FROM seen""",
    "watched": "SELECT DISTINCT user_id, item_id FROM known WHERE is_watched",
    "item_genre": "SELECT item_id, trim(unnest(string_split(genres, ','))) AS genre FROM items",
    "affinity": """SELECT user_id, genre, sum(increment) AS affinity FROM known JOIN item_genre USING (item_id)
        GROUP BY 1, 2""",
    "recent10": """SELECT *, count(*) OVER (PARTITION BY user_id) - position AS step FROM recent
        WHERE position <= 10""",
    "session": """SELECT user_id, item_id, CASE step WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.7::DOUBLE
        WHEN 2 THEN 0.7::DOUBLE * 0.7::DOUBLE WHEN 3 THEN 0.7::DOUBLE * 0.7::DOUBLE * 0.7::DOUBLE
        ELSE 0.7::DOUBLE * 0.7::DOUBLE * 0.7::DOUBLE * 0.7::DOUBLE END AS score FROM recent10 WHERE step < 5""",
    "edge_scores": """SELECT r.user_id, n.neighbor_item_id AS item_id, n.algorithm AS source,
        CAST(sum(CAST(n.score AS DECIMAL(18,6))) AS DOUBLE) AS score
        FROM recent10 r JOIN neighbors n ON n.source_item_id = r.item_id GROUP BY 1, 2, 3""",
    "offered": """SELECT user_id, item_id, source, score FROM edge_scores
        UNION ALL SELECT user_id, item_id, 'session', score FROM session
        UNION ALL SELECT user_id, item_id, 'trending', score FROM users JOIN trending USING (region)""",
    "matrix": """SELECT user_id, item_id,
        coalesce(max(score) FILTER (source = 'collaborative'), 0.0) AS collaborative,
        coalesce(max(score) FILTER (source = 'content'), 0.0) AS content,
        coalesce(max(score) FILTER (source = 'session'), 0.0) AS session,
        coalesce(max(score) FILTER (source = 'trending'), 0.0) AS trending FROM offered GROUP BY 1, 2""",
    "normal": "SELECT user_id, item_id, " + ", ".join(
        f"{c} / coalesce(nullif(max({c}) OVER (PARTITION BY user_id), 0.0), 1.0) AS {c}"
        for c in ("collaborative", "content", "session", "trending")) + " FROM matrix",
    "unwatched": "SELECT * FROM normal n WHERE NOT EXISTS (SELECT 1 FROM watched w WHERE w.user_id = n.user_id "
                 "AND w.item_id = n.item_id)",
    "titled": """SELECT u.*, i.title, i.genres, i.release_year, i.maturity_rating, i.available_regions
        FROM unwatched u JOIN items i USING (item_id) WHERE i.is_active""",
    "profiled": "SELECT t.*, u.region, u.maturity_rating AS user_rating FROM titled t JOIN users u USING (user_id)",
    "in_region": """SELECT * FROM profiled
        WHERE contains(available_regions, region) OR contains(available_regions, 'GLOBAL')""",
    "allowed": f"SELECT * FROM in_region WHERE {_level('maturity_rating', 0)} <= {_level('user_rating', 2)}",
    "bonus": """SELECT a.user_id, a.item_id, least(coalesce(CAST(sum(f.affinity) AS DOUBLE), 0.0) / 10.0, 1.0)
        AS genre_bonus FROM allowed a JOIN item_genre g USING (item_id)
        LEFT JOIN affinity f ON f.user_id = a.user_id AND f.genre = g.genre GROUP BY 1, 2""",
    "blend_parts": """SELECT a.*, b.genre_bonus,
        least(greatest(CAST(a.release_year - 2020 AS DOUBLE) / 6.0, 0.0), 1.0) AS freshness
        FROM allowed a JOIN bonus b USING (user_id, item_id)""",
    "scored": """SELECT *, 0.35::DOUBLE * collaborative + 0.25::DOUBLE * content + 0.2::DOUBLE * session
        + 0.1::DOUBLE * trending + 0.05::DOUBLE * freshness + 0.05::DOUBLE * genre_bonus AS blend,
        greatest(collaborative, content, session, trending, freshness, genre_bonus) AS top,
        trim(split_part(genres, ',', 1)) AS lead_genre FROM blend_parts""",
    "reasoned": """SELECT *, CASE WHEN collaborative = top THEN 'collaborative' WHEN content = top THEN 'content'
        WHEN session = top THEN 'session' WHEN trending = top THEN 'trending'
        WHEN freshness = top THEN 'freshness' ELSE 'genre_bonus' END AS reason FROM scored""",
    "capped": """SELECT * FROM reasoned QUALIFY row_number() OVER (PARTITION BY user_id, lead_genre
        ORDER BY blend DESC, item_id) <= 2""",
    "ranked": """SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY blend DESC, item_id) AS position
        FROM capped QUALIFY position <= 10""",
    "served": """SELECT user_id, position, item_id, title, genres, round(blend, 4) AS score, reason,
        round(collaborative, 4) AS collaborative, round(content, 4) AS content, round(session, 4) AS session,
        round(trending, 4) AS trending, round(freshness, 4) AS freshness, round(genre_bonus, 4) AS genre_bonus
        FROM ranked""",
    "priors": """SELECT 'u' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS user_id, genre, prior
        FROM customer JOIN (VALUES ('BUILDING', 'bolt', 3), ('BUILDING', 'plate', 2), ('MACHINERY', 'gear', 3),
        ('MACHINERY', 'rod', 2), ('AUTOMOBILE', 'gear', 2), ('AUTOMOBILE', 'bolt', 1), ('HOUSEHOLD', 'plate', 3),
        ('FURNITURE', 'ring', 1)) v(segment, genre, prior) ON c_mktsegment = segment""",
    "cold": """SELECT p.user_id, p.item_id, round(1.0::DOUBLE + coalesce(sum(prior), 0)
        + greatest(0, any_value(i.release_year) - 2022) * 0.3::DOUBLE, 6) AS score
        FROM (SELECT DISTINCT user_id, item_id FROM known) p JOIN items i USING (item_id)
        JOIN item_genre g USING (item_id) LEFT JOIN priors r ON r.user_id = p.user_id AND r.genre = g.genre
        GROUP BY 1, 2""",
    "versions": """SELECT 'hybrid-' || strftime(max(ts), '%Y%m%d%H%M%S') AS version, max(ts) AS created_at
        FROM events GROUP BY CAST(ts AS DATE)""",
}


def statement(select: str) -> str:
    """The select with all the common table expressions it needs, directly or through others."""
    needed: set[str] = set()

    def collect(text: str) -> None:
        for word in set(re.findall(r"\w+", text)):
            if word in CTES and word not in needed:
                needed.add(word)
                collect(CTES[word])

    collect(select)
    parts = [f"{name} AS ({CTES[name]})" for name in CTES if name in needed]
    text = ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select
    return text.replace("{STOP}", _STOP_LIST)
