"""The same results in plain SQL, written on their own: one statement per registered query.

Statements are put together from named common table expressions; ``sql`` adds the ones a
final select needs, in order.
"""

import re

from shoplens import config
from shoplens.sources.tables import DUCKDB_EVENTS

POOL, K = config.CANDIDATE_POOL, config.TOP_N


def settled(value, digits):
    """Rounds a value that already has SCORE_DIGITS digits, in decimal arithmetic."""
    return f"CAST(round(CAST({value} AS DECIMAL(24, {config.SCORE_DIGITS})), {digits}) AS DOUBLE)"


CTES = {
    "ev": DUCKDB_EVENTS,
    "wt": """SELECT *, CASE event_type WHEN 'purchase' THEN 5 WHEN 'cart' THEN 3 WHEN 'view' THEN 1 ELSE 0 END AS w,
        coalesce(category_code, 'cid:' || CAST(category_id AS VARCHAR)) AS category FROM ev""",
    "dc": """SELECT *, pow(0.5, date_diff('day', CAST(timestamp AS DATE), (SELECT CAST(max(timestamp) AS DATE) FROM ev)) / 14.0)
        AS decay FROM wt""",
    "mx": "SELECT user_id, item_id, sum(w * decay) AS score FROM dc GROUP BY ALL",
    "feat": """SELECT item_id, CAST(sum(w) AS DOUBLE) AS popularity, CASE WHEN sum(CAST(event_type = 'view' AS INT)) > 0
        THEN sum(CAST(event_type IN ('purchase', 'cart') AS INT)) / sum(CAST(event_type = 'view' AS INT)) ELSE 0.0 END AS conversion
        FROM wt GROUP BY item_id""",
    "basics": "SELECT item_id, max(category_code) AS code, max(category_id) AS cid, max(brand) AS brand FROM ev GROUP BY item_id",
    "meta": """SELECT item_id, max(brand) AS brand, max(category_code) AS category_code, max(category_id) AS category_id,
        CAST(round(CAST(avg(price) AS DECIMAL(24, 8)), 2) AS DOUBLE) AS price, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'cart') AS carts,
        count(*) FILTER (event_type = 'purchase') AS purchases, count(DISTINCT user_id) AS unique_users FROM ev GROUP BY item_id""",
    "items": """SELECT meta.*, round(popularity, 3) AS popularity_score, round(conversion, 4) AS conversion_rate,
        coalesce(split_part(category_code, '.', 1), 'other') AS root,
        coalesce(category_code, 'cid:' || CAST(category_id AS VARCHAR)) AS category
        FROM meta JOIN feat USING (item_id)""",
    "tokens": """SELECT item_id, 'cat:' || array_to_string(string_split(code, '.')[1:n], '.') AS token
          FROM basics, range(1, 20) r(n) WHERE code IS NOT NULL AND n <= len(string_split(code, '.'))
        UNION SELECT item_id, 'cid:' || CAST(cid AS VARCHAR) FROM basics WHERE cid IS NOT NULL
        UNION SELECT item_id, 'brand:' || brand FROM basics WHERE brand IS NOT NULL""",
    "idf": """SELECT token, count(*) AS df, ln(((SELECT count(*) FROM basics) + 1) / (count(*) + 1)) + 1 AS idf
        FROM tokens GROUP BY token""",
    "tfidf": """SELECT item_id, token, idf / sqrt(sum(idf * idf) OVER (PARTITION BY item_id)) AS weight
        FROM tokens JOIN idf USING (token)""",
    "counts": "SELECT user_id, count(*) AS n FROM ev GROUP BY user_id",
    "pool": f"SELECT item_id, popularity FROM feat ORDER BY popularity DESC, item_id LIMIT {POOL}",
    "profile": """SELECT user_id, token, w / norm AS w FROM (
          SELECT user_id, token, w, sqrt(sum(w * w) OVER (PARTITION BY user_id)) AS norm FROM (
            SELECT user_id, token, sum(score * weight) AS w FROM mx JOIN tfidf USING (item_id) GROUP BY ALL)) WHERE norm > 0""",
    "cold": f"SELECT user_id FROM counts WHERE n <= {config.COLD_START_MAX_EVENTS}",
    "coldmx": "SELECT * FROM mx WHERE user_id IN (SELECT user_id FROM cold)",
    "pair_side": """SELECT *, CAST('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|' || CAST(item_id AS VARCHAR)), 1, 8) AS BIGINT) % 100
        AS side FROM mx""",
    "train": f"SELECT user_id, item_id, score FROM pair_side WHERE side < {config.TRAIN_PERCENT}",
    "test": f"SELECT user_id, item_id, score FROM pair_side WHERE side >= {config.TRAIN_PERCENT}",
    "eusers": "SELECT DISTINCT user_id FROM test WHERE user_id IN (SELECT user_id FROM train)",
    "truth": "SELECT user_id, item_id FROM test WHERE user_id IN (SELECT user_id FROM eusers)",
    "ecold": f"""SELECT user_id FROM eusers WHERE user_id IN
        (SELECT user_id FROM train GROUP BY user_id HAVING count(*) <= {config.COLD_START_MAX_EVENTS})""",
    "trainpop": "SELECT item_id, sum(score) AS popularity FROM train GROUP BY item_id",
    "poprecs": f"""SELECT user_id, item_id, rank FROM (
          SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY round(popularity, 10) DESC, item_id) AS rank
          FROM eusers CROSS JOIN (SELECT * FROM trainpop ORDER BY round(popularity, 10) DESC, item_id LIMIT
            (SELECT {K} + max(n) FROM (SELECT count(*) AS n FROM train GROUP BY user_id))) p
          WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = eusers.user_id AND t.item_id = p.item_id))
        WHERE rank <= {K}""",
    "sess": """SELECT session_id, item_id, max(w) AS w FROM wt GROUP BY ALL HAVING max(w) > 0""",
    "elig": """SELECT * FROM sess WHERE session_id IN (SELECT session_id FROM sess GROUP BY session_id HAVING count(*) > 1)""",
    "also": f"""SELECT * FROM (SELECT item_id, other_id, score, sessions,
            row_number() OVER (PARTITION BY item_id ORDER BY score DESC, other_id) AS rank FROM (
          SELECT p.item_id, p.other_id, round(p.w / sqrt(a.total * b.total), 10) AS score, p.sessions FROM (
            SELECT x.item_id, y.item_id AS other_id, sum(least(x.w, y.w)) AS w, count(*) AS sessions
            FROM elig x JOIN elig y ON x.session_id = y.session_id AND x.item_id <> y.item_id GROUP BY ALL) p
          JOIN (SELECT item_id, sum(w) AS total FROM elig GROUP BY item_id) a ON a.item_id = p.item_id
          JOIN (SELECT item_id, sum(w) AS total FROM elig GROUP BY item_id) b ON b.item_id = p.other_id))
        WHERE rank <= {config.NEIGHBOURS}""",
    "ucat": "SELECT DISTINCT user_id, category_code FROM wt WHERE category_code IS NOT NULL AND w > 0",
    "compl": f"""SELECT * FROM (SELECT category, other, score, users,
            row_number() OVER (PARTITION BY category ORDER BY score DESC, other) AS rank FROM (
          SELECT p.category, p.other, p.users, round(p.users / sqrt(a.n * b.n) * p.users / (p.users + {config.COMPLEMENT_SHRINKAGE}), 10) AS score
          FROM (SELECT x.category_code AS category, y.category_code AS other, count(*) AS users FROM ucat x
            JOIN ucat y ON x.user_id = y.user_id AND x.category_code <> y.category_code GROUP BY ALL
            HAVING count(*) >= {config.MIN_SHARED_USERS}) p
          JOIN (SELECT category_code, count(*) AS n FROM ucat GROUP BY ALL) a ON a.category_code = p.category
          JOIN (SELECT category_code, count(*) AS n FROM ucat GROUP BY ALL) b ON b.category_code = p.other))
        WHERE rank <= {config.COMPLEMENTS}""",
    "idx": f"""SELECT *, row_number() OVER (ORDER BY popularity_score DESC, CAST(item_id AS VARCHAR) DESC) AS place FROM items""",
    "emb": "SELECT CAST(vec_id AS INT) AS item_id, embedding AS v FROM embeddings",
    "topprofile": f"""SELECT user_id, token, {settled('w', 4)} AS w FROM (SELECT user_id, token, round(w, 10) AS w,
        row_number() OVER (PARTITION BY user_id ORDER BY round(w, 10) DESC, token) AS rank FROM profile)
        WHERE rank <= {config.PROFILE_TOKENS}""",
    "seen": f"""SELECT user_id, item_id FROM (SELECT user_id, item_id,
        row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS rank FROM mx) WHERE rank <= {config.SEEN_ITEMS}""",
    "ustats": """SELECT user_id, count(*) AS n_events, count(*) FILTER (event_type = 'view') AS views,
        count(*) FILTER (event_type = 'cart') AS carts, count(*) FILTER (event_type = 'purchase') AS purchases,
        count(DISTINCT item_id) AS n_items, count(DISTINCT session_id) AS n_sessions, CAST(round(CAST(avg(price) AS DECIMAL(24, 8)), 2) AS DOUBLE) AS avg_price,
        strftime(min(timestamp), '%Y-%m-%d %H:%M') AS first_seen, strftime(max(timestamp), '%Y-%m-%d %H:%M') AS last_seen,
        CASE WHEN count(*) <= 3 THEN 'cold_start' ELSE 'warm' END AS segment FROM ev GROUP BY user_id""",
}


def shares_cte(key):
    return f"""SELECT user_id, key, round(w / total, 4) AS share, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY w DESC, key) AS rank FROM (
          SELECT *, sum(w) OVER (PARTITION BY user_id) AS total FROM (
            SELECT user_id, {key} AS key, sum(w) AS w FROM wt WHERE {key} IS NOT NULL GROUP BY ALL)) WHERE total > 0)
        WHERE rank <= {config.TOP_SHARES}"""


def content_cte(history, popularity, k=K):
    """Content recommendations for a history table over a popularity table."""
    return f"""SELECT user_id, item_id, score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY over_cap, score DESC, popularity DESC, item_id) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, brand_key ORDER BY score DESC, popularity DESC, item_id)
            > {config.BRAND_CAP} AS over_cap FROM (
          SELECT s.user_id, s.item_id, s.score, p.popularity, coalesce('brand:' || b.brand, CAST(s.item_id AS VARCHAR)) AS brand_key
          FROM (SELECT user_id, item_id, round(max(score), 10) AS score FROM (
              SELECT user_id, item_id, sum(pw * weight) AS score FROM (
                SELECT user_id, token, w / norm AS pw FROM (
                  SELECT user_id, token, w, sqrt(sum(w * w) OVER (PARTITION BY user_id)) AS norm FROM (
                    SELECT user_id, token, sum(score * weight) AS w FROM {history} JOIN tfidf USING (item_id) GROUP BY ALL))
                WHERE norm > 0)
              JOIN tfidf USING (token) WHERE item_id IN (SELECT item_id FROM {popularity} ORDER BY popularity DESC, item_id LIMIT {POOL})
              GROUP BY ALL
            UNION ALL
              SELECT user_id, item_id, 0.0 FROM (SELECT DISTINCT user_id FROM {history}) CROSS JOIN
                (SELECT item_id FROM {popularity} ORDER BY popularity DESC, item_id LIMIT {k + config.COLD_START_MAX_EVENTS}))
            GROUP BY ALL) s
          JOIN {popularity} p ON p.item_id = s.item_id JOIN basics b ON b.item_id = s.item_id
          WHERE NOT EXISTS (SELECT 1 FROM {history} h WHERE h.user_id = s.user_id AND h.item_id = s.item_id))))
    WHERE rank <= {k}"""



# --- re-ranker -------------------------------------------------------------------

CTES["sim"] = f"""SELECT * FROM (SELECT a.item_id, b.item_id AS other_id, round(list_cosine_similarity(a.v, b.v), 10) AS score,
      row_number() OVER (PARTITION BY a.item_id ORDER BY round(list_cosine_similarity(a.v, b.v), 10) DESC, b.item_id) AS rank
    FROM embd a JOIN embd b ON a.item_id <> b.item_id WHERE b.item_id IN (SELECT item_id FROM pool)
      AND list_cosine_similarity(a.v, b.v) > 0)
    WHERE rank <= {config.NEIGHBOURS}"""
CTES["embd"] = f"""SELECT CAST(vec_id AS INT) AS item_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IN
    (SELECT item_id FROM mx GROUP BY item_id HAVING count(*) >= {config.MIN_EMBEDDING_USERS})"""
CTES["vec"] = "SELECT CAST(vec_id AS INT) AS id, list_transform(embedding, lambda x: round(CAST(x AS DOUBLE), 5)) AS v FROM embeddings"
CTES["newest"] = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY timestamp DESC, item_id, event_type, price) - 1 AS pos FROM wt"
CTES["live"] = f"""SELECT user_id, item_id, event_type, pos, timestamp FROM (
      SELECT *, sum(pause) OVER (PARTITION BY user_id ORDER BY pos) AS past FROM (
        SELECT *, CASE WHEN lag(timestamp) OVER (PARTITION BY user_id ORDER BY pos) - timestamp
          >= INTERVAL {config.SESSION_TTL_SECONDS} SECOND THEN 1 ELSE 0 END AS pause FROM newest WHERE pos < {config.SESSION_MAX_EVENTS}))
    WHERE past = 0"""
CTES["lw"] = """SELECT *, CASE event_type WHEN 'purchase' THEN 5 WHEN 'cart' THEN 3 WHEN 'view' THEN 1
      WHEN 'remove_from_cart' THEN 0 ELSE 1 END AS sw FROM live"""
CTES["tokw"] = "SELECT item_id, token, round(weight, 4) AS tw FROM tfidf"
CTES["tokn"] = "SELECT item_id, sqrt(sum(tw * tw)) AS norm FROM tokw GROUP BY item_id"
CTES["sprof"] = f"SELECT user_id, token, sum(sw * pow({config.SESSION_DECAY}, pos) * tw) AS w FROM lw JOIN tokw USING (item_id) GROUP BY ALL"
for _name, _key in (("scats", "category"), ("sbrands", "brand")):
    CTES[_name] = f"""SELECT user_id, key, w / sum(w) OVER (PARTITION BY user_id) AS share FROM (
      SELECT user_id, {_key} AS key, sum(greatest(sw, 1)) AS w FROM lw JOIN items USING (item_id) WHERE {_key} IS NOT NULL GROUP BY ALL)"""
CTES["vcats"] = "SELECT user_id, key, share FROM cats UNION ALL SELECT user_id, key, share FROM scats WHERE user_id NOT IN (SELECT user_id FROM cats)"
CTES["vbrands"] = "SELECT user_id, key, share FROM brands UNION ALL SELECT user_id, key, share FROM sbrands WHERE user_id NOT IN (SELECT user_id FROM brands)"
CTES["vroots"] = "SELECT user_id, split_part(key, '.', 1) AS root, sum(share) AS share FROM vcats GROUP BY ALL"
CTES["ctlists"] = """SELECT user_id, item_id, rank, 'content' AS source FROM content UNION ALL
    SELECT user_id, item_id, rank, 'als' FROM poprecs WHERE user_id NOT IN (SELECT user_id FROM content)"""
CTES["req"] = """SELECT 'home:' || CAST(user_id AS VARCHAR) AS request_id, user_id, CAST(NULL AS INT) AS ctx FROM newest WHERE pos = 0
    UNION ALL SELECT 'product:' || CAST(user_id AS VARCHAR), user_id, item_id FROM newest WHERE pos = 0"""
CTES["incode"] = "SELECT category_code, item_id, row_number() OVER (PARTITION BY category_code ORDER BY place) AS rank FROM idx WHERE category_code IS NOT NULL"
CTES["inid"] = "SELECT category_id, item_id, row_number() OVER (PARTITION BY category_id ORDER BY place) AS rank FROM idx WHERE category_id IS NOT NULL"
CTES["dept"] = """SELECT root, category_code, sum(popularity_score) AS popularity, min(place) AS place FROM idx
    WHERE category_code IS NOT NULL GROUP BY ALL"""
CTES["learned"] = f"SELECT category, other, {settled('score', 4)} AS score, users, rank FROM compl"
CTES["allcompl"] = f"""SELECT category, other, score, users, 'learned' AS kind, rank,
      CASE WHEN max(score) OVER (PARTITION BY category) > 0 THEN round(score / max(score) OVER (PARTITION BY category), 4)
        ELSE {config.DEPARTMENT_VALUE} END AS value FROM learned
    UNION ALL SELECT category, other, NULL, 0, 'department', n + rank, {config.DEPARTMENT_VALUE} FROM (
      SELECT c.category, c.n, d.category_code AS other,
        row_number() OVER (PARTITION BY c.category ORDER BY d.popularity DESC, d.place) AS rank
      FROM (SELECT i.category_code AS category, count(DISTINCT l.other) AS n FROM items i
          LEFT JOIN learned l ON l.category = i.category_code WHERE i.category_code IS NOT NULL GROUP BY ALL) c
      JOIN dept d ON d.root = split_part(c.category, '.', 1) AND d.category_code <> c.category
      WHERE NOT EXISTS (SELECT 1 FROM learned l WHERE l.category = c.category AND l.other = d.category_code))
    WHERE rank <= {config.MIN_COMPLEMENTS} - n"""
CTES["cand"] = f"""SELECT request_id, user_id, ctx, item_id, arg_min(source, prio) AS source FROM (
      SELECT r.*, a.other_id AS item_id, 'copurchase' AS source, 1 AS prio FROM req r JOIN also a ON a.item_id = r.ctx
      UNION ALL SELECT r.*, s.other_id, 'similar', 2 FROM req r JOIN sim s ON s.item_id = r.ctx
      UNION ALL SELECT r.*, c.item_id, 'category', 3 FROM req r JOIN items i ON i.item_id = r.ctx
        JOIN incode c ON c.category_code = i.category_code AND c.rank <= {config.CATEGORY_CANDIDATES}
      UNION ALL SELECT r.*, c.item_id, 'category', 3 FROM req r JOIN items i ON i.item_id = r.ctx AND i.category_code IS NULL
        JOIN inid c ON c.category_id = i.category_id AND c.rank <= {config.CATEGORY_CANDIDATES}
      UNION ALL SELECT r.*, c.item_id, 'complement', 4 FROM req r JOIN items i ON i.item_id = r.ctx
        JOIN allcompl m ON m.category = i.category_code AND m.rank <= {config.COMPLEMENTS_USED}
        JOIN incode c ON c.category_code = m.other AND c.rank <= {config.ITEMS_PER_COMPLEMENT}
      UNION ALL SELECT r.*, l.item_id, l.source, 5 FROM req r JOIN ctlists l ON l.user_id = r.user_id
      UNION ALL SELECT r.*, a.other_id, 'session', 6 FROM req r JOIN live s ON s.user_id = r.user_id AND s.pos < {config.SESSION_ANCHORS}
        JOIN also a ON a.item_id = s.item_id AND a.rank <= {config.NEIGHBOURS_PER_ANCHOR}
      UNION ALL SELECT r.*, a.other_id, 'session', 6 FROM req r JOIN live s ON s.user_id = r.user_id AND s.pos < {config.SESSION_ANCHORS}
        JOIN sim a ON a.item_id = s.item_id AND a.rank <= {config.NEIGHBOURS_PER_ANCHOR}
      UNION ALL SELECT r.*, p.item_id, 'popular', 7 FROM req r CROSS JOIN (SELECT item_id FROM idx WHERE place <= {config.POPULAR_CANDIDATES}) p) c
    WHERE item_id IS DISTINCT FROM ctx
      AND NOT EXISTS (SELECT 1 FROM mx WHERE mx.user_id = c.user_id AND mx.item_id = c.item_id)
      AND NOT EXISTS (SELECT 1 FROM live WHERE live.user_id = c.user_id AND live.item_id = c.item_id)
      AND EXISTS (SELECT 1 FROM items WHERE items.item_id = c.item_id)
    GROUP BY ALL"""
CTES["copur"] = f"""SELECT request_id, item_id, max(score) AS score FROM (
      SELECT r.request_id, a.other_id AS item_id, {settled('a.score', 4)} AS score FROM req r JOIN also a ON a.item_id = r.ctx
      UNION ALL SELECT r.request_id, a.other_id, {settled('a.score', 4)} FROM req r
        JOIN live s ON s.user_id = r.user_id AND s.pos < {config.COPURCHASE_ANCHORS} JOIN also a ON a.item_id = s.item_id) GROUP BY ALL"""
CTES["ctxcos"] = """SELECT x.item_id AS ctx, y.item_id, sum(x.tw * y.tw) / (any_value(a.norm) * any_value(b.norm)) AS v FROM tokw x
    JOIN tokw y ON x.token = y.token JOIN tokn a ON a.item_id = x.item_id JOIN tokn b ON b.item_id = y.item_id
    WHERE (x.item_id, y.item_id) IN (SELECT DISTINCT (ctx, item_id) FROM cand WHERE ctx IS NOT NULL) GROUP BY ALL"""
CTES["upair"] = "SELECT DISTINCT user_id, item_id FROM cand"
CTES["contentcos"] = """SELECT p.user_id, p.item_id, sum(u.w * t.tw) / (any_value(n.norm) * any_value(k.norm)) AS v FROM upair p
    JOIN tokw t ON t.item_id = p.item_id JOIN topprofile u ON u.user_id = p.user_id AND u.token = t.token
    JOIN (SELECT user_id, sqrt(sum(w * w)) AS norm FROM topprofile GROUP BY ALL) n ON n.user_id = p.user_id
    JOIN tokn k ON k.item_id = p.item_id GROUP BY ALL"""
CTES["sesscos"] = """SELECT p.user_id, p.item_id, sum(u.w * t.tw) / (any_value(n.norm) * any_value(k.norm)) AS v FROM upair p
    JOIN tokw t ON t.item_id = p.item_id JOIN sprof u ON u.user_id = p.user_id AND u.token = t.token
    JOIN (SELECT user_id, sqrt(sum(w * w)) AS norm FROM sprof GROUP BY ALL HAVING sum(w * w) > 0) n ON n.user_id = p.user_id
    JOIN tokn k ON k.item_id = p.item_id GROUP BY ALL"""
CTES["refprice"] = """SELECT r.request_id, coalesce(nullif(i.price, 0), nullif(u.avg_price, 0),
      (SELECT avg(nullif(x.price, 0)) FROM live s JOIN items x ON x.item_id = s.item_id WHERE s.user_id = r.user_id)) AS ref
    FROM req r LEFT JOIN items i ON i.item_id = r.ctx LEFT JOIN ustats u ON u.user_id = r.user_id"""
CTES["fac"] = """SELECT c.request_id, c.item_id, c.source, i.category AS item_category, c.ctx IS NOT NULL AS product,
      CASE WHEN uv.v IS NOT NULL AND iv.v IS NOT NULL THEN round(greatest(list_dot_product(uv.v, iv.v), 0.0), 10) END AS als_raw,
      coalesce(x.v, 0.0) AS context, coalesce(m.value, 0.0) AS complement, coalesce(cp.score, 0.0) AS copurchase,
      coalesce(ct.v, 0.0) AS content, coalesce(ss.v, 0.0) AS session,
      least(1.0, coalesce(vc.share, 0.0) + 0.5 * (coalesce(vr.share, 0.0) - coalesce(vc.share, 0.0))) AS category,
      CASE WHEN i.price > 0 AND rp.ref > 0 THEN exp(-abs(ln(i.price / rp.ref))) ELSE 0.0 END AS price,
      coalesce(vb.share, 0.0) AS brand,
      coalesce(ln(1 + i.popularity_score) / nullif(max(ln(1 + i.popularity_score)) OVER (PARTITION BY c.request_id), 0), 0.0) AS popularity
    FROM cand c JOIN items i ON i.item_id = c.item_id LEFT JOIN items ci ON ci.item_id = c.ctx
    LEFT JOIN vec uv ON uv.id = c.user_id LEFT JOIN vec iv ON iv.id = c.item_id
    LEFT JOIN ctxcos x ON x.ctx = c.ctx AND x.item_id = c.item_id
    LEFT JOIN allcompl m ON m.category = ci.category_code AND m.other = i.category
    LEFT JOIN copur cp ON cp.request_id = c.request_id AND cp.item_id = c.item_id
    LEFT JOIN contentcos ct ON ct.user_id = c.user_id AND ct.item_id = c.item_id
    LEFT JOIN sesscos ss ON ss.user_id = c.user_id AND ss.item_id = c.item_id
    LEFT JOIN vcats vc ON vc.user_id = c.user_id AND vc.key = i.category
    LEFT JOIN vroots vr ON vr.user_id = c.user_id AND vr.root = split_part(i.category_code, '.', 1)
    LEFT JOIN vbrands vb ON vb.user_id = c.user_id AND vb.key = i.brand
    LEFT JOIN refprice rp ON rp.request_id = c.request_id"""


def _total(profile, prefix=""):
    return " + ".join(f"{w} * {prefix}{'least(coalesce(als_raw, 0.0), 1.0)' if n == 'als' else n}" for n, (_, w) in profile.items())


CTES["scored"] = f"""SELECT *, {settled('final', 4)} AS score FROM (SELECT *, round(CASE WHEN product
    THEN {_total(config.RANKING_PROFILES['product'])} ELSE {_total(config.RANKING_PROFILES['home'])} END, 10) AS final FROM fac)"""
CTES["placed"] = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY adj DESC, item_id) AS position FROM (
      SELECT *, round(score * pow(dec, j), 12) AS adj FROM (
        SELECT *, CASE WHEN product THEN {config.VARIETY_DECAY['product']} ELSE {config.VARIETY_DECAY['home']} END AS dec,
          row_number() OVER (PARTITION BY request_id, item_category ORDER BY score DESC, item_id) - 1 AS j FROM scored)))
    WHERE position <= 12"""
CTES["sample"] = """SELECT user_id FROM (SELECT DISTINCT user_id FROM content)
    ORDER BY md5(CAST(user_id AS VARCHAR) || '|42'), user_id LIMIT 5"""
CTES["samplecodes"] = """SELECT DISTINCT user_id, code FROM ev JOIN basics USING (item_id)
    WHERE code IS NOT NULL AND user_id IN (SELECT user_id FROM sample)"""
CTES["samplelap"] = """SELECT user_id, coalesce(string_agg(code, ',' ORDER BY code), '') AS overlap FROM sample
    LEFT JOIN (SELECT user_id, code FROM samplecodes WHERE (user_id, code) IN
      (SELECT (user_id, code) FROM content JOIN basics USING (item_id) WHERE rank <= 10)) USING (user_id) GROUP BY user_id"""
CTES["cats"] = shares_cte("category")
CTES["brands"] = shares_cte("brand")
CTES["content"] = content_cte("coldmx", "feat")
CTES["ecoldtrain"] = "SELECT * FROM train WHERE user_id IN (SELECT user_id FROM ecold)"
CTES["econtent"] = content_cte("ecoldtrain", "trainpop", max(config.EVAL_KS))


def sql(final):
    """``final`` with the common table expressions it names, and those they name."""
    order, done = [], set()

    def need(text):
        for name in CTES:
            if name not in done and re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", text):
                done.add(name)
                need(CTES[name])
                order.append(name)

    need(final)
    if not order:
        return final
    parts = ",\n".join(f"{name} AS MATERIALIZED (\n{CTES[name]}\n)" for name in order)
    return f"WITH {parts}\n{final}"
