"""SQL counterparts of the registered queries, composed from shared WITH parts.

Each part names the parts it reads; a statement carries only what it needs.
"""

from __future__ import annotations

import math

from coldspring.functions import buckets, text
from coldspring.operators import metrics, scorer, weights  # noqa: F401  (weights documents the formulas)
from coldspring.plans import analysis, serving

_PARTS: dict[str, str] = {}
SEED = 42


def _part(name: str, sql: str) -> None:
    _PARTS[name] = sql


def _r(expression: str) -> str:
    return f"round(({expression}) + 1e-11::DOUBLE, 6) + 0.0"


def _md5(tag: str, seed: int, *ids: str) -> str:
    tail = "".join(f" || ':' || {i}::VARCHAR" for i in ids)
    return f"md5('{tag}:{seed}'{tail})"


def _word(digest: str, index: int) -> str:
    return f"('0x' || substr({digest}, {8 * index + 1}, 8))::BIGINT"


def _normal(tag: str, seed: int, *ids: str) -> str:
    d = _md5(tag, seed, *ids)
    return (f"sqrt(-2.0::DOUBLE * ln(({_word(d, 0)} + 1.0::DOUBLE) / 4294967296.0::DOUBLE)) * "
            f"cos({2 * math.pi!r}::DOUBLE * ({_word(d, 1)} / 4294967296.0::DOUBLE))")


# --- data set and split ---------------------------------------------------------

_part("items", """SELECT p_partkey AS item_id, p_name AS title, 1950 + p_size AS year, [p_type, p_brand] AS genres
  FROM part""")
_part("raw", """SELECT o_custkey AS user_id, l_partkey AS item_id, 1.0::DOUBLE + floor((l_quantity - 1) / 10) AS rating,
  epoch(o_orderdate)::BIGINT AS ts FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
_part("ratings", "SELECT user_id, item_id, max(rating) AS rating, min(ts) AS ts FROM raw SEMI JOIN items USING (item_id) GROUP BY 1, 2")
_part("users", """SELECT c_custkey AS user_id, c_mktsegment AS gender, n_regionkey AS age
  FROM customer JOIN nation ON c_nationkey = n_nationkey""")


def _split(prefix: str, source: str, seed: int) -> None:
    for side, key, share, at_least in (("users", "user_id", 0.10, 10), ("items", "item_id", 0.05, 20)):
        _part(f"{prefix}{side}_n", f"SELECT {key}, count(*) AS n FROM {source} GROUP BY 1")
        _part(f"{prefix}cold_{side}", f"""SELECT {key}, ({_word(_md5(f"keep-{key}", seed, key), 0)} % 5) AS keep_n
          FROM (SELECT {key}, row_number() OVER (ORDER BY {_md5(f"cold-{key}", seed, key)}, {key}) AS place
                FROM {prefix}{side}_n WHERE n >= {at_least})
          WHERE place <= (SELECT round_even({share}::DOUBLE * count(*), 0) FROM {prefix}{side}_n)""")
    _part(f"{prefix}flagged", f"""SELECT r.*, cu.keep_n AS keep_user, ci.keep_n AS keep_item,
        CASE WHEN cu.keep_n IS NOT NULL AND ci.keep_n IS NOT NULL THEN 'both_cold'
             WHEN ci.keep_n IS NOT NULL THEN 'item_cold' WHEN cu.keep_n IS NOT NULL THEN 'user_cold'
             ELSE 'both_warm' END AS case_id
      FROM {source} r LEFT JOIN {prefix}cold_users cu USING (user_id) LEFT JOIN {prefix}cold_items ci USING (item_id)""")
    _part(f"{prefix}placed", f"""SELECT *, row_number() OVER (PARTITION BY case_id,
          CASE WHEN case_id = 'item_cold' THEN item_id ELSE user_id END ORDER BY ts, user_id, item_id) - 1 AS pos,
        count(*) OVER (PARTITION BY case_id, CASE WHEN case_id = 'item_cold' THEN item_id ELSE user_id END) AS size
      FROM {prefix}flagged""")
    _part(f"{prefix}split", f"""SELECT user_id, item_id, rating, ts, case_id, CASE case_id WHEN 'both_cold' THEN false
        WHEN 'item_cold' THEN pos < keep_item WHEN 'user_cold' THEN pos < keep_user
        ELSE pos < size - floor(size * 0.2::DOUBLE) END AS in_train FROM {prefix}placed""")


_split("", "ratings", SEED)
_part("outer_train", "SELECT user_id, item_id, rating, ts FROM split WHERE in_train")
_split("inner_", "outer_train", SEED + 1)

_part("train", "SELECT user_id, item_id, sum(rating) AS rating FROM split WHERE in_train GROUP BY 1, 2")
_part("user_stats", """SELECT user_id, count(t.item_id) AS n_user FROM (SELECT DISTINCT user_id FROM ratings)
  LEFT JOIN train t USING (user_id) GROUP BY 1""")
_part("item_stats", """SELECT i.item_id, count(t.user_id) AS n_item FROM items i LEFT JOIN train t USING (item_id)
  GROUP BY 1""")
_part("liked", "SELECT DISTINCT user_id, item_id FROM split WHERE NOT in_train AND rating >= 4")
_part("totals", "SELECT sum(n_item)::DOUBLE AS pairs, count(*)::DOUBLE AS n_items FROM item_stats")
_part("eval_users", """SELECT user_id, count(*) AS n_relevant, n_user AS n_train FROM liked JOIN user_stats USING (user_id)
  GROUP BY user_id, n_user""")
_part("cold_ids", "SELECT item_id FROM item_stats WHERE n_item < 5")
_part("cold_eval_users", """SELECT user_id, count(*) AS n_relevant, n_user AS n_train FROM liked
  JOIN cold_ids USING (item_id) JOIN user_stats USING (user_id) GROUP BY user_id, n_user""")

# --- popularity -------------------------------------------------------------------

_part("global_pop", """SELECT item_id, n_item, (n_item + 1.0::DOUBLE) / (SELECT pairs + n_items FROM totals) AS g
  FROM item_stats""")
_part("segments", "SELECT user_id, gender || '-' || age AS segment FROM users WHERE user_id IN (SELECT user_id FROM user_stats)")
_part("segment_n", "SELECT segment, item_id, count(*) AS n FROM train JOIN segments USING (user_id) GROUP BY 1, 2")
_part("segment_total", "SELECT segment, sum(n) AS total FROM segment_n GROUP BY 1")
_part("segment_pop", """SELECT segment, item_id, ln((coalesce(n, 0) + 1000 * g) / (coalesce(total, 0) + 1000)) AS score
  FROM (SELECT DISTINCT segment FROM segments) CROSS JOIN global_pop LEFT JOIN segment_n USING (segment, item_id)
  LEFT JOIN segment_total USING (segment)""")
_part("pct", """SELECT item_id, n_item, (row_number() OVER (ORDER BY n_item, item_id) - 1)
  / greatest((SELECT n_items FROM totals) - 1, 1) AS pct FROM item_stats""")
_part("head", """SELECT item_id, n_item, coalesce(sum(n_item) OVER (ORDER BY n_item DESC, item_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / (SELECT pairs FROM totals) < 0.5 AS is_head FROM item_stats""")

# --- content ------------------------------------------------------------------------

_part("blocks", """SELECT item_id, 'genre:' || g AS feature, 1.0::DOUBLE / sqrt(len(list_distinct(genres))) AS value
  FROM (SELECT item_id, genres, unnest(list_distinct(genres)) AS g FROM items)
  UNION ALL SELECT item_id, 'decade:' || (year // 10 * 10), 0.5::DOUBLE FROM items""")
_part("features", """SELECT item_id, feature, value / sqrt(sum(value * value) OVER (PARTITION BY item_id)) AS value
  FROM blocks""")
_part("raw_profiles", """SELECT user_id, feature, sum((rating - 2.5) * value) AS value FROM train JOIN features USING (item_id)
  GROUP BY 1, 2""")
_part("profile_norm", "SELECT user_id, sqrt(sum(value * value)) AS length FROM raw_profiles GROUP BY 1")
_part("profiles", """SELECT user_id, feature, CASE WHEN length > 0 THEN value / length ELSE value END AS value
  FROM raw_profiles JOIN profile_norm USING (user_id)""")
_part("tokens", r"""SELECT item_id, unnest(regexp_extract_all(lower(title), '\b[a-z][a-z0-9'']+\b')) AS term FROM items""")
_part("tf", "SELECT item_id, term, count(*) AS tf FROM tokens GROUP BY 1, 2")
_part("idf", """SELECT term, ln((1.0::DOUBLE + (SELECT count(*) FROM items)) / (count(*) + 1)) + 1 AS idf FROM tf
  GROUP BY 1 HAVING count(*) >= 2""")
_part("tfidf", """SELECT item_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS w
  FROM (SELECT item_id, term, (1 + ln(tf::DOUBLE)) * idf AS w FROM tf JOIN idf USING (term))""")

# Two leading directions of the TF-IDF rows: the terms' Gram matrix is squared until only the first direction is left
# (power 2^14), then the same without that direction.
SQUARINGS = 14


def _leading(prefix: str, start: str) -> None:
    _part(f"{prefix}0", start)
    for step in range(1, SQUARINGS + 1):
        last = f"{prefix}{step - 1}"
        _part(f"{prefix}{step}", f"""SELECT a.i, b.j, sum(a.m * b.m) / any_value(s.t) AS m FROM {last} a JOIN {last} b ON a.j = b.i
          CROSS JOIN (SELECT sum(m * m) AS t FROM {last}) s GROUP BY 1, 2""")
    # every column is a multiple of the direction; the longest one is the most exact
    _part(f"{prefix}dir", f"""SELECT i AS term, m / sqrt(sum(m * m) OVER ()) AS v FROM {prefix}{SQUARINGS}
      WHERE j = (SELECT j FROM {prefix}{SQUARINGS} WHERE i = j ORDER BY m DESC, j LIMIT 1)""")


_part("term_gram", """SELECT i, j, coalesce(m, 0) AS m FROM (SELECT a.term AS i, b.term AS j FROM idf a CROSS JOIN idf b) LEFT JOIN
  (SELECT a.term AS i, b.term AS j, sum(a.w * b.w) AS m FROM tfidf a JOIN tfidf b USING (item_id) GROUP BY 1, 2) USING (i, j)""")
_leading("lead", "SELECT * FROM term_gram")
_part("lead_weight", "SELECT sum(a.v * m * b.v) AS l FROM term_gram JOIN leaddir a ON a.term = i JOIN leaddir b ON b.term = j")
_leading("next", """SELECT i, j, m - (SELECT l FROM lead_weight) * a.v * b.v AS m FROM term_gram JOIN leaddir a ON a.term = i
  JOIN leaddir b ON b.term = j""")

# --- one-factor least squares (alpha 1, lambda 1, two rounds) ---------------------------

_part("y0", f"SELECT item_id AS id, 0.01::DOUBLE * ({_normal('als', 7, 'item_id', '0')}) AS v FROM items")
for _i, (_name, _prev, _target, _source) in enumerate(
        [("x1", "y0", "user_id", "item_id"), ("y1", "x1", "item_id", "user_id"),
         ("x2", "y1", "user_id", "item_id"), ("y2", "x2", "item_id", "user_id")]):
    _part(_name, f"""SELECT t.{_target} AS id, sum(p.v * (1 + t.rating)) / (sum(t.rating * p.v * p.v)
      + (SELECT sum(v * v) + 1.0 FROM {_prev})) AS v FROM train t JOIN {_prev} p ON p.id = t.{_source} GROUP BY 1""")

# --- two factors: the 2 x 2 normal equations, solved by Cramer's rule ------------------------

_part("b0", f"""SELECT item_id AS id, 0.01::DOUBLE * ({_normal('als', 7, 'item_id', '0')}) AS p, 0.01::DOUBLE * ({_normal('als', 7, 'item_id', '1')}) AS q
  FROM items""")


def _two_factors(name: str, prev: str, pairs: str, target: str, source: str, ridge: float = 1.0, alpha: float = 1.0) -> None:
    w = f"{alpha!r}::DOUBLE * t.rating"
    _part(name, f"""SELECT id, (bp * cqq - bq * cpq) / (cpp * cqq - cpq * cpq) AS p, (bq * cpp - bp * cpq) / (cpp * cqq - cpq * cpq) AS q FROM (
        SELECT t.{target} AS id, sum({w} * f.p * f.p) + any_value(g.pp) AS cpp, sum({w} * f.p * f.q) + any_value(g.pq) AS cpq,
          sum({w} * f.q * f.q) + any_value(g.qq) AS cqq, sum(f.p * (1 + {w})) AS bp, sum(f.q * (1 + {w})) AS bq
        FROM {pairs} t JOIN {prev} f ON f.id = t.{source}
        CROSS JOIN (SELECT sum(p * p) + {ridge!r}::DOUBLE AS pp, sum(p * q) AS pq, sum(q * q) + {ridge!r}::DOUBLE AS qq FROM {prev}) g GROUP BY 1)""")


for _name, _prev, _target, _source in [("a1", "b0", "user_id", "item_id"), ("b1", "a1", "item_id", "user_id"),
                                       ("a2", "b1", "user_id", "item_id"), ("b2", "a2", "item_id", "user_id")]:
    _two_factors(_name, _prev, "train", _target, _source)
_part("rank2_lists", """SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM (
  SELECT user_id, item_id, round(coalesce(a.p * b.p + a.q * b.q, 0), 6) + 0.0 AS score FROM eval_users CROSS JOIN items
  LEFT JOIN a2 a ON a.id = user_id LEFT JOIN b2 b ON b.id = item_id ANTI JOIN train USING (user_id, item_id))""")

# --- all signals of every known user and item ---------------------------------------------

_part("cosines", """SELECT user_id, item_id, sum(p.value * f.value) AS c FROM profiles p JOIN features f USING (feature)
  GROUP BY 1, 2""")
_part("has_profile", "SELECT user_id FROM profiles GROUP BY 1 HAVING bool_or(value <> 0)")


def _signals(users: str) -> str:
    return f"""SELECT u.user_id, u.n_user, g.item_id, g.n_item, coalesce(x.v, 0) * coalesce(y.v, 0) AS cf,
      CASE WHEN hp.user_id IS NULL THEN 0 ELSE coalesce(c.c, 0) + 1e-6 * ln(1.0::DOUBLE + g.n_item) END AS content,
      coalesce(sp.score, ln(g.g)) AS demographic, ln(g.g) AS popularity, x.v IS NOT NULL AND x.v <> 0 AS has_cf,
      hp.user_id IS NOT NULL AS has_content
    FROM {users} u CROSS JOIN global_pop g LEFT JOIN x2 x ON x.id = u.user_id LEFT JOIN y2 y ON y.id = g.item_id
    LEFT JOIN has_profile hp ON hp.user_id = u.user_id
    LEFT JOIN cosines c ON c.user_id = u.user_id AND c.item_id = g.item_id
    LEFT JOIN segments s ON s.user_id = u.user_id
    LEFT JOIN segment_pop sp ON sp.segment = s.segment AND sp.item_id = g.item_id"""


_part("signals", _signals("user_stats"))


def _zscored(signals: str) -> str:
    def z(name, known):
        mean, sd = f"avg({name}) OVER (PARTITION BY user_id)", f"stddev_pop({name}) OVER (PARTITION BY user_id)"
        return f"CASE WHEN {known} AND {sd} > 1e-12 THEN ({name} - {mean}) / {sd} ELSE 0 END"
    return f"""SELECT *, {z('cf', 'has_cf')} AS z_cf, {z('content', 'has_content')} AS z_content,
      {z('demographic', 'true')} AS z_popularity FROM {signals}"""


_part("z", _zscored("signals"))

_C_CF = "(n_user / (n_user + 30.0::DOUBLE)) * (n_item / (n_item + 300.0::DOUBLE))"
_T = "(n_user / (n_user + 30.0::DOUBLE))"
_WEIGHTS = {"adaptive": (_C_CF, f"(1 - {_C_CF}) * {_T}", f"(1 - {_C_CF}) * (1 - {_T})"),
            "switch": ("CASE WHEN n_user >= 5 AND n_item >= 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END",
                       "CASE WHEN n_user > 0 AND NOT (n_user >= 5 AND n_item >= 5) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END",
                       "CASE WHEN n_user = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"),
            "fixed": ("0.5::DOUBLE", "0.5::DOUBLE", "0.0::DOUBLE")}


def _blend(mode: str) -> str:
    return " + ".join(f"({w}) * {zs}" for w, zs in zip(_WEIGHTS[mode], ("z_cf", "z_content", "z_popularity")))


_SCORES = {scorer.POPULARITY: "popularity", scorer.DEMOGRAPHIC: "demographic", scorer.CF: "cf", scorer.CONTENT: "content",
           scorer.FIXED: _blend("fixed"), scorer.SWITCH: _blend("switch"), scorer.ADAPTIVE: _blend("adaptive")}


def _lists(users: str, k: int, models=None, only: str = "") -> str:
    """Top k of unseen items per model and user; ``only`` restricts the candidates."""
    picks = []
    for model in models or _SCORES:
        picks.append(f"""SELECT '{model}' AS model, user_id, n_user AS n_train, item_id, n_item,
          round({_SCORES[model]}, 9) + 0.0 AS score FROM z JOIN {users} USING (user_id)
          ANTI JOIN train USING (user_id, item_id) {only}""")
    each = [f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
      FROM ({p})) WHERE rank <= {k}""" for p in picks]
    body = " UNION ALL ".join(each)
    return f"SELECT b.*, l.user_id IS NOT NULL AS hit FROM ({body}) b LEFT JOIN liked l USING (user_id, item_id)"


# --- diversity re-ranking, twenty greedy steps -------------------------------------------------

_part("mmr_pool", f"""SELECT user_id, item_id, score, place, CASE WHEN hi > lo THEN (score - lo) / (hi - lo) ELSE 1.0::DOUBLE END
    - 0.1::DOUBLE * pct AS relevance
  FROM (SELECT *, min(score) OVER (PARTITION BY user_id) AS lo, max(score) OVER (PARTITION BY user_id) AS hi FROM (
    SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS place
    FROM (SELECT user_id, item_id, round({_blend('adaptive')}, 9) + 0.0 AS score FROM z JOIN eval_users USING (user_id)
          ANTI JOIN train USING (user_id, item_id))) WHERE place <= 100) JOIN pct USING (item_id)""")
_part("cos_pairs", "SELECT a.item_id AS a, b.item_id AS b, sum(a.value * b.value) AS c FROM features a JOIN features b USING (feature) GROUP BY 1, 2")
_part("m0", "SELECT user_id, item_id, place, relevance, 0.0::DOUBLE AS nearest, 0 AS picked FROM mmr_pool")
for _step in range(1, 21):
    _part(f"p{_step}", f"""SELECT user_id, item_id FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id
      ORDER BY round(0.7::DOUBLE * relevance - 0.3::DOUBLE * nearest, 9) DESC, place) AS o FROM m{_step - 1}
      WHERE picked = 0) WHERE o = 1""")
    _part(f"m{_step}", f"""SELECT m.user_id, m.item_id, place, relevance, greatest(nearest, coalesce(c, 0)) AS nearest,
      CASE WHEN picked = 0 AND m.item_id = p.item_id THEN {_step} ELSE picked END AS picked
      FROM m{_step - 1} m LEFT JOIN p{_step} p USING (user_id)
      LEFT JOIN cos_pairs ON a = m.item_id AND b = p.item_id""")

_part("plain_lists", _lists("eval_users", 20))
_part("lists", f"""SELECT * FROM plain_lists UNION ALL BY NAME SELECT '{scorer.MMR}' AS model, m.user_id, u.n_train, m.item_id, i.n_item,
  NULL::DOUBLE AS score, m.picked AS rank, l.user_id IS NOT NULL AS hit FROM m20 m JOIN eval_users u USING (user_id)
  JOIN item_stats i ON i.item_id = m.item_id LEFT JOIN liked l ON l.user_id = m.user_id AND l.item_id = m.item_id WHERE m.picked > 0""")
_part("cold_lists", _lists("cold_eval_users", 20, only="SEMI JOIN cold_ids USING (item_id)"))


def _ideal(k: int) -> str:
    sums, total = [], 0.0
    for rank in range(1, k + 1):
        total += 1.0 / math.log2(rank + 1)
        sums.append(f"{total!r}::DOUBLE")
    return f"([{', '.join(sums)}])[least(n_relevant, {k})]"


def _frame(lists: str, users: str, models: list[str]) -> str:
    cols = []
    for k in (5, 10, 20):
        hits = f"coalesce(count(*) FILTER (WHERE hit AND rank <= {k}), 0)"
        dcg = f"coalesce(sum(1.0::DOUBLE / log2(rank + 1.0::DOUBLE)) FILTER (WHERE hit AND rank <= {k}), 0)"
        cols += [f"{hits} / {k}.0::DOUBLE AS precision_{k}", f"{hits} / n_relevant::DOUBLE AS recall_{k}",
                 f"{dcg} / {_ideal(k)} AS ndcg_{k}", f"CASE WHEN {hits} > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS hit_{k}"]
    models = ", ".join(f"('{m}')" for m in models)
    return f"""SELECT m.model, u.user_id, u.n_relevant, u.n_train, {', '.join(cols)},
        avg(-log2((n_item + 1.0::DOUBLE) / ((SELECT count(*) FROM user_stats) + 1.0::DOUBLE))) FILTER (WHERE rank <= 10) AS novelty
      FROM {users} u CROSS JOIN (VALUES {models}) m(model)
      LEFT JOIN {lists} l ON l.model = m.model AND l.user_id = u.user_id GROUP BY 1, 2, 3, 4"""


_part("frame", _frame("lists", "eval_users", [*_SCORES, scorer.MMR]))
_part("cold_frame", _frame("cold_lists", "cold_eval_users", list(_SCORES)))


def _diversity(lists: str) -> str:
    return f"""SELECT model, user_id, CASE WHEN any_value(len) >= 2 THEN
        1 - (sum(s * s) - any_value(len)) / (any_value(len) * (any_value(len) - 1.0::DOUBLE)) END AS diversity
      FROM (SELECT model, user_id, feature, sum(value) AS s FROM {lists} JOIN features USING (item_id)
            WHERE rank <= 10 GROUP BY 1, 2, 3)
      JOIN (SELECT model, user_id, count(*) AS len FROM {lists} WHERE rank <= 10 GROUP BY 1, 2) USING (model, user_id)
      GROUP BY 1, 2"""


_part("diverse", _diversity("lists"))
_part("cold_diverse", _diversity("cold_lists"))
_EXACT = " ".join(f"WHEN {n} THEN '{metrics.exact_slice(n)}'" for n in range(5))
_part("user_slices", f"""SELECT user_id, unnest(CASE WHEN n_train >= 5 THEN ['{metrics.ALL}', '{metrics.warm_slice(5)}']
  ELSE ['{metrics.ALL}', '{metrics.cold_slice(5)}', CASE n_train {_EXACT} END] END) AS slice FROM eval_users""")
_part("cold_user_slices", f"SELECT user_id, '{metrics.cold_item_slice(5)}' AS slice FROM cold_eval_users")


def _summary(frame: str, lists: str, diverse: str, slices: str, names: list[str], models: list[str]) -> str:
    every = ", ".join(f"('{n}', '{m}')" for n in names for m in models)
    return f"""SELECT slice, model, coalesce(users, 0) AS users, precision, recall, ndcg, hit, coalesce(coverage, 0) AS coverage,
        coalesce(novelty, 0) AS novelty, coalesce(diversity, 0) AS diversity
      FROM (VALUES {every}) e(slice, model) LEFT JOIN (SELECT slice, model, count(*) AS users, avg(precision_10) AS precision, avg(recall_10) AS recall,
              avg(ndcg_10) AS ndcg, avg(hit_10) AS hit, avg(novelty) AS novelty, avg(diversity) AS diversity
            FROM {frame} JOIN {slices} USING (user_id) LEFT JOIN {diverse} USING (model, user_id) GROUP BY 1, 2) USING (slice, model)
      LEFT JOIN (SELECT slice, model, count(DISTINCT item_id) / (SELECT n_items FROM totals) AS coverage
            FROM {lists} JOIN {slices} USING (user_id) WHERE rank <= 10 GROUP BY 1, 2) USING (slice, model)"""


_part("summary", _summary("frame", "lists", "diverse", "user_slices", metrics.slice_names(5), [*_SCORES, scorer.MMR])
      + " UNION ALL " + _summary("cold_frame", "cold_lists", "cold_diverse", "cold_user_slices", [metrics.cold_item_slice(5)], list(_SCORES)))

# --- a model from outside: distance of prices, bare and with at most two items of a decade --------

_part("taste", "SELECT user_id, avg(ln(p_retailprice::DOUBLE)) AS taste FROM train JOIN part ON p_partkey = item_id GROUP BY 1")
_part("price_lists", """SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS place FROM (
  SELECT user_id, item_id, year // 10 * 10 AS decade, round(-abs(taste - ln(p_retailprice::DOUBLE)) / ln(2.0::DOUBLE), 9) + 0.0 AS score
  FROM taste SEMI JOIN eval_users USING (user_id) CROSS JOIN items JOIN part ON p_partkey = item_id ANTI JOIN train USING (user_id, item_id))""")
_part("price_mixed", """SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY place) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, decade ORDER BY place) AS nth FROM price_lists WHERE place <= 50) WHERE nth <= 2""")

# --- people outside the training data ---------------------------------------------------------

_part("new_pairs", """SELECT l_suppkey::BIGINT AS request_id, l_partkey AS item_id,
  avg(1.0::DOUBLE + floor((l_quantity - 1) / 10)) AS rating FROM lineitem GROUP BY 1, 2""")
_part("new_people", """SELECT s_suppkey::BIGINT AS user_id, CASE WHEN s_suppkey % 3 <> 0 THEN 'BUILDING-' || n_regionkey END AS segment,
  coalesce(n, 0) AS n_user FROM supplier JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN (SELECT request_id, count(*) AS n FROM new_pairs GROUP BY 1) ON request_id = s_suppkey""")
_part("folded", """SELECT request_id AS id, sum(y.v * (1 + rating)) / (sum(rating * y.v * y.v)
  + (SELECT sum(v * v) + 1.0 FROM y2)) AS v FROM new_pairs JOIN y2 y ON y.id = item_id GROUP BY 1""")
_two_factors("folded2", "b2", "new_pairs", "request_id", "item_id")
_part("new_raw_profiles", """SELECT request_id AS user_id, feature, sum((rating - 2.5) * value) AS value
  FROM new_pairs JOIN features USING (item_id) GROUP BY 1, 2""")
_part("new_profiles", """SELECT user_id, feature, CASE WHEN length > 0 THEN value / length ELSE value END AS value
  FROM new_raw_profiles JOIN (SELECT user_id, sqrt(sum(value * value)) AS length FROM new_raw_profiles GROUP BY 1) USING (user_id)""")
_part("new_cosines", """SELECT user_id, item_id, sum(p.value * f.value) AS c FROM new_profiles p JOIN features f USING (feature)
  GROUP BY 1, 2""")
_part("new_has", "SELECT user_id FROM new_profiles GROUP BY 1 HAVING bool_or(value <> 0)")
_part("new_signals", """SELECT u.user_id, u.n_user, g.item_id, g.n_item, coalesce(x.v, 0) * coalesce(y.v, 0) AS cf,
    CASE WHEN hp.user_id IS NULL THEN 0 ELSE coalesce(c.c, 0) + 1e-6 * ln(1.0::DOUBLE + g.n_item) END AS content,
    coalesce(sp.score, ln(g.g)) AS demographic, x.v IS NOT NULL AND x.v <> 0 AS has_cf, hp.user_id IS NOT NULL AS has_content
  FROM new_people u CROSS JOIN global_pop g LEFT JOIN folded x ON x.id = u.user_id LEFT JOIN y2 y ON y.id = g.item_id
  LEFT JOIN new_has hp ON hp.user_id = u.user_id LEFT JOIN new_cosines c ON c.user_id = u.user_id AND c.item_id = g.item_id
  LEFT JOIN segment_pop sp ON sp.segment = u.segment AND sp.item_id = g.item_id""")
_part("new_z", _zscored("new_signals"))

# --- requests built from orders ------------------------------------------------------------------

_KEYS = ", ".join(f"'{k}'" for k in serving.MODEL_KEYS)
_part("requests", f"""SELECT o_orderkey AS request_id, CASE WHEN o_orderkey % 23 = 0 THEN 'nope'
    ELSE ([{_KEYS}])[o_orderkey % 6 + 1] END AS model, o_orderkey % 55 AS k,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 'abc'
    WHEN o_orderkey % 19 = 0 THEN (o_custkey + 1000000000)::VARCHAR ELSE o_custkey::VARCHAR END AS user_id,
  CASE WHEN o_orderkey % 7 = 0 THEN 'X' WHEN o_orderkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  CASE WHEN o_orderkey % 29 = 0 THEN 26 ELSE 25 END AS age FROM orders""")
_part("request_ratings", """SELECT l_orderkey AS request_id, count(*) AS n,
  bool_or(CASE WHEN l_orderkey % 11 = 0 THEN l_partkey + 1000000000 ELSE l_partkey END NOT IN (SELECT item_id FROM items)) AS unknown_item,
  bool_or(NOT (CASE WHEN l_orderkey % 13 = 0 THEN 9.0 ELSE 1.0 + floor((l_quantity - 1) / 10) END BETWEEN 0.5 AND 5)) AS bad_range
  FROM lineitem GROUP BY 1""")
_part("checked", f"""SELECT request_id, concat_ws(',', CASE WHEN model NOT IN ({_KEYS}) THEN 'unknown_model' END,
    CASE WHEN NOT k BETWEEN 1 AND 50 THEN 'bad_k' END,
    CASE WHEN user_id IS NOT NULL AND try_cast(user_id AS BIGINT) IS NULL THEN 'bad_user_id' END,
    CASE WHEN try_cast(user_id AS BIGINT) NOT IN (SELECT user_id FROM user_stats) THEN 'unknown_user' END,
    CASE WHEN user_id IS NULL AND n > 200 THEN 'too_many_ratings' END,
    CASE WHEN user_id IS NULL AND unknown_item THEN 'unknown_item' END,
    CASE WHEN user_id IS NULL AND bad_range THEN 'rating_range' END,
    CASE WHEN user_id IS NULL AND gender NOT IN ('M', 'F') THEN 'bad_gender' END,
    CASE WHEN user_id IS NULL AND age NOT IN ({', '.join(map(str, buckets.AGE_LABELS))}) THEN 'bad_age' END) AS errors
  FROM requests LEFT JOIN request_ratings USING (request_id)""")

# --- buckets ----------------------------------------------------------------------------------------

_HISTORY = "CASE " + " ".join(f"WHEN {{n}} BETWEEN {lo} AND {hi} THEN '{label}'" for lo, hi, label in buckets.HISTORY) + " END"
_HISTORY_ROWS = ", ".join(f"({i}::BIGINT, '{label}', {float(lo if hi == buckets.OPEN_END else (lo + hi) / 2)}::DOUBLE)"
                          for i, (lo, hi, label) in enumerate(buckets.HISTORY))
_part("mainstream", """SELECT user_id, avg(pct) AS mainstream FROM train JOIN pct USING (item_id) GROUP BY 1""")
_part("warm_adaptive", f"""SELECT user_id, ndcg_10, recall_10, mainstream FROM frame JOIN mainstream USING (user_id)
  WHERE model = '{scorer.ADAPTIVE}' AND n_train >= 5""")
_part("edges", "SELECT quantile_cont(mainstream, [0.2, 0.4, 0.6, 0.8]) AS e FROM warm_adaptive")
_part("item_relevant", "SELECT item_id, count(*) AS relevant FROM liked GROUP BY 1")


def _swap(sql: str, names: dict) -> str:
    """Replace whole words."""
    out, word = [], ""
    for ch in sql + " ":
        if ch.isalnum() or ch == "_":
            word += ch
        else:
            out += [names.get(word, word), ch]
            word = ""
    return "".join(out)


def _copy(prefix: str, names: list[str], swaps: dict | None = None) -> None:
    """Define ``names`` again under a prefix, reading each other and ``swaps``."""
    table = {**{n: prefix + n for n in names}, **(swaps or {})}
    for name in names:
        _part(prefix + name, _swap(_PARTS[name], table))


# The validation split: the same models fitted on the inner training rows.
_copy("inner_", ["train", "user_stats", "item_stats", "liked", "totals", "eval_users", "cold_ids", "cold_eval_users", "global_pop",
                 "segments", "segment_n", "segment_total", "segment_pop", "raw_profiles", "profile_norm", "profiles", "x1", "y1",
                 "x2", "y2", "cosines", "has_profile", "signals", "z"], {"split": "inner_split"})
_GRID = ", ".join(f"({a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)" for a in (3, 10, 30, 100, 300) for b in (3, 10, 30, 100, 300, 1000) for c in (3, 10, 30, 100, 300))
_part("grid", f"SELECT * FROM (VALUES {_GRID}) g(k_user, k_item, k_content)")


def _grid_hits(users: str, only: str = "") -> str:
    cf = "(n_user / (n_user + k_user)) * (n_item / (n_item + k_item))"
    t = "(n_user / (n_user + k_content))"
    # the ten best by score, then lowest id, kept while scanning
    return f"""SELECT k_user, k_item, k_content, r.user_id, n_relevant, n_train,
        coalesce(sum(1.0::DOUBLE / log2(rank + 1.0::DOUBLE)) FILTER (WHERE l.item_id IS NOT NULL), 0) / {_ideal(10)} AS ndcg
      FROM (SELECT k_user, k_item, k_content, user_id, n_relevant, n_train, -unnest(top).i AS item_id, generate_subscripts(top, 1) AS rank
        FROM (SELECT k_user, k_item, k_content, user_id, any_value(n_relevant) AS n_relevant, any_value(n_train) AS n_train,
            max({{'s': round({cf} * z_cf + (1 - {cf}) * {t} * z_content + (1 - {cf}) * (1 - {t}) * z_popularity, 9) + 0.0, 'i': -item_id}}, 10) AS top
          FROM inner_z JOIN {users} USING (user_id) ANTI JOIN inner_train USING (user_id, item_id) {only} CROSS JOIN grid GROUP BY 1, 2, 3, 4)) r
      LEFT JOIN inner_liked l ON l.user_id = r.user_id AND l.item_id = r.item_id
      GROUP BY k_user, k_item, k_content, r.user_id, n_relevant, n_train"""


_part("grid_ndcg", _grid_hits("inner_eval_users"))
_part("grid_cold_ndcg", _grid_hits("inner_cold_eval_users", "SEMI JOIN inner_cold_ids USING (item_id)"))
_part("grid_slices", """SELECT k_user, k_item, k_content, avg(ndcg) FILTER (WHERE n_train >= 5) AS warm_users,
    avg(ndcg) FILTER (WHERE n_train < 5) AS cold_users FROM grid_ndcg GROUP BY 1, 2, 3""")
_part("grid_cold_slice", "SELECT k_user, k_item, k_content, avg(ndcg) AS cold_items FROM grid_cold_ndcg GROUP BY 1, 2, 3")

# The factor grid: each point fitted on the inner training rows, ranked for warm users.
_part("flat0", "SELECT id, p, 0.0::DOUBLE AS q FROM b0")
ALS_POINTS = [(f, r, a) for f in (1, 2) for r, a in ((1.0, 1.0), (5.0, 0.25), (20.0, 1.0))]
_point_sums = []
for _at, (_factors, _ridge, _alpha) in enumerate(ALS_POINTS):
    _last = "flat0" if _factors == 1 else "b0"      # with q = 0 everywhere the second factor stays 0
    for _round in (1, 2):
        _two_factors(f"gu{_at}_{_round}", _last, "inner_train", "user_id", "item_id", _ridge, _alpha)
        _two_factors(f"gi{_at}_{_round}", f"gu{_at}_{_round}", "inner_train", "item_id", "user_id", _ridge, _alpha)
        _last = f"gi{_at}_{_round}"
    _part(f"als_ndcg{_at}", f"""SELECT {_factors}::BIGINT AS factors, {_ridge!r}::DOUBLE AS regularization, {_alpha!r}::DOUBLE AS alpha,
        sum(coalesce(gain, 0)) / count(*) AS ndcg FROM (SELECT user_id, n_relevant FROM inner_eval_users WHERE n_train >= 5) LEFT JOIN (
        SELECT r.user_id, sum(1.0::DOUBLE / log2(rank + 1.0::DOUBLE)) / any_value({_ideal(10)}) AS gain FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM (
            SELECT user_id, n_relevant, item_id, round(coalesce(u.p * i.p + u.q * i.q, 0), 9) + 0.0 AS score FROM inner_eval_users CROSS JOIN items
            LEFT JOIN gu{_at}_2 u ON u.id = user_id LEFT JOIN gi{_at}_2 i ON i.id = item_id ANTI JOIN inner_train USING (user_id, item_id))) r
        JOIN inner_liked l ON l.user_id = r.user_id AND l.item_id = r.item_id WHERE rank <= 10 GROUP BY 1) USING (user_id)""")
    _point_sums.append(f"SELECT factors, regularization, alpha, {_r('ndcg')} AS ndcg FROM als_ndcg{_at}")

# Content without the decade block, ranked on the cold-item slice.
_part("genre_only_blocks", "SELECT * FROM blocks WHERE feature LIKE 'genre:%'")
_copy("genre_only_", ["features", "raw_profiles", "profile_norm", "profiles", "cosines", "has_profile", "signals", "z"],
      {"blocks": "genre_only_blocks"})
_part("genre_only_lists", _swap(_lists("cold_eval_users", 10, [scorer.CONTENT], "SEMI JOIN cold_ids USING (item_id)"),
                                {"z": "genre_only_z"}))
_part("genre_only_frame", f"""SELECT u.user_id, coalesce(sum(1.0::DOUBLE / log2(rank + 1.0::DOUBLE)) FILTER (WHERE hit), 0)
    / {_ideal(10)} AS ndcg FROM cold_eval_users u LEFT JOIN genre_only_lists l ON l.user_id = u.user_id GROUP BY u.user_id, n_relevant""")

# The worst cold users and the hardest cold items.
_part("shown", "SELECT item_id, title || ' (' || year || ')' AS shown FROM items")
_part("worst", f"""SELECT user_id, n_relevant FROM frame WHERE model = '{scorer.ADAPTIVE}' AND n_train BETWEEN 1 AND 4
  ORDER BY round(ndcg_10, 9), n_relevant DESC, user_id LIMIT 3""")
_part("liked_ranked", """SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY n_item DESC, item_id) AS rank
  FROM liked JOIN item_stats USING (item_id) SEMI JOIN worst USING (user_id)""")
_part("popular_cold", """SELECT item_id, count(*) AS fans_in_test FROM split JOIN cold_ids USING (item_id)
  WHERE NOT in_train AND rating >= 4 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 40""")
_part("fans", "SELECT item_id, user_id FROM split SEMI JOIN popular_cold USING (item_id) WHERE NOT in_train AND rating >= 4")
_part("fan_rate", f"""SELECT f.item_id, avg((l.item_id IS NOT NULL)::INT) AS hit_rate FROM fans f LEFT JOIN
  (SELECT user_id, item_id FROM cold_lists WHERE model = '{scorer.ADAPTIVE}' AND rank <= 10) l
  ON l.user_id = f.user_id AND l.item_id = f.item_id GROUP BY 1""")
_part("hardest", """SELECT item_id, fans_in_test, hit_rate FROM popular_cold JOIN fan_rate USING (item_id)
  ORDER BY hit_rate, fans_in_test DESC, item_id LIMIT 6""")
_part("nearest", """SELECT n.item_id, string_agg(shown, ' | ' ORDER BY rank) AS near FROM (
    SELECT h.item_id, j.item_id AS other, row_number() OVER (PARTITION BY h.item_id ORDER BY round(coalesce(c, 0), 9) DESC, j.item_id) AS rank
    FROM hardest h CROSS JOIN items j LEFT JOIN cos_pairs ON a = h.item_id AND b = j.item_id WHERE h.item_id <> j.item_id) n
  JOIN shown s ON s.item_id = other WHERE rank <= 3 GROUP BY 1""")


def _words(sql: str) -> set:
    out, word = set(), ""
    for ch in sql + " ":
        if ch.isalnum() or ch == "_":
            word += ch
        else:
            out.add(word)
            word = ""
    return out


def with_parts(sql: str) -> str:
    """Prefix ``sql`` with the WITH parts it needs, in the order they were defined."""
    needed, todo = set(), [sql]
    while todo:
        for name in _words(todo.pop()) & set(_PARTS):
            if name not in needed:
                needed.add(name)
                todo.append(_PARTS[name])
    if not needed:
        return sql
    parts = ",\n".join(f"{name} AS MATERIALIZED ({body})" for name, body in _PARTS.items() if name in needed)
    return f"WITH {parts}\n{sql}"


def _top_list(model: str) -> str:
    return with_parts(f"SELECT user_id, rank, item_id, score FROM lists WHERE model = '{model}' AND rank <= 10")


def _weights_sql(mode: str) -> str:
    cf, content, pop = _WEIGHTS[mode]
    return with_parts(f"""SELECT user_id, item_id, {_r(cf)} AS w_cf, {_r(content)} AS w_content, {_r(pop)} AS w_popularity
      FROM ratings JOIN user_stats USING (user_id) JOIN item_stats USING (item_id)""")


def _mean_weights(n: str, source: str, columns: str) -> str:
    cf = f"({n} / ({n} + 30.0::DOUBLE)) * (n_item / (n_item + 300.0::DOUBLE))"
    t = f"({n} / ({n} + 30.0::DOUBLE))"
    mean = lambda w: _r(f"sum(({w}) * n_item) / sum(n_item)")
    return with_parts(f"""SELECT {columns}, {mean(cf)} AS cf_weight, {mean(f"(1 - {cf}) * {t}")} AS content_weight,
      {mean(f"(1 - {cf}) * (1 - {t})")} AS popularity_weight FROM {source} CROSS JOIN item_stats GROUP BY {columns}""")


_METRIC_COLUMNS = ", ".join(f"{_r(m)} AS {m}" for m in ("precision", "recall", "ndcg", "hit", "coverage", "novelty", "diversity"))


_EXAMPLES = """SELECT label, user_id, ratings FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY user_id) - 1 AS pos,
            count(*) OVER (PARTITION BY label) AS size FROM (SELECT user_id, n_user AS ratings, unnest([
              CASE WHEN n_user = 0 THEN 'new sign-up' END, CASE WHEN n_user = 1 THEN '1 rating' END,
              CASE WHEN n_user = 3 THEN '3 ratings' END, CASE WHEN n_user >= 40 THEN 'warm' END,
              CASE WHEN n_user >= 300 THEN 'power user' END]) AS label
            FROM user_stats SEMI JOIN liked USING (user_id)) WHERE label IS NOT NULL) WHERE pos = size // 2"""


def statements() -> dict[str, str]:
    cold_item = metrics.cold_item_slice(5)
    out = {
        "interactions_collapse": "SELECT user_id, item_id, sum(rating) AS rating FROM raw GROUP BY 1, 2",
        "drop_orphan_ratings": "SELECT user_id, item_id, rating, ts FROM ratings WHERE item_id IN (SELECT item_id FROM items WHERE list_contains(genres, 'PROMO'))",
        "cold_pick_users": "SELECT user_id, keep_n FROM cold_users",
        "cold_pick_items": "SELECT item_id, keep_n FROM cold_items",
        "cold_start_split": "SELECT user_id, item_id, rating, ts, case_id, in_train FROM split",
        "split_counts": "SELECT case_id, in_train, count(*) AS n FROM split GROUP BY 1, 2",
        "interaction_stats": """SELECT 'user' AS side, user_id AS id, n_user AS n FROM user_stats
          UNION ALL SELECT 'item', item_id, n_item FROM item_stats""",
        "sample_users": f"""SELECT user_id, item_id, rating, ts FROM ratings WHERE user_id IN (SELECT user_id FROM
          (SELECT DISTINCT user_id FROM ratings) ORDER BY {_md5('sample', 0, 'user_id')}, user_id LIMIT 500)""",
        "sample_users_table": f"""SELECT user_id, gender, age::BIGINT AS age FROM users WHERE user_id IN (SELECT user_id FROM
          (SELECT DISTINCT user_id FROM ratings) ORDER BY {_md5('sample', 0, 'user_id')}, user_id LIMIT 500)""",
        "truth_relevant": "SELECT user_id, item_id FROM liked",
        "validation_split": "SELECT user_id, item_id, case_id, in_train FROM inner_split",
        "history_buckets": f"SELECT {_HISTORY.format(n='n_user')} AS history, count(*) AS users FROM user_stats GROUP BY 1",
        "display_titles": "SELECT item_id, title || CASE WHEN item_id % 10 <> 0 THEN ' (' || year || ')' ELSE '' END AS shown FROM items",
        "popularity_global": f"SELECT item_id, {_r('ln(g)')} AS score FROM global_pop",
        "popularity_segment": f"SELECT segment, item_id, {_r('score')} AS score FROM segment_pop",
        "popularity_percentile": f"SELECT item_id, {_r('pct')} AS pct FROM pct",
        "head_tail_items": "SELECT item_id, n_item, is_head FROM head",
        "item_feature_blocks": f"SELECT item_id, feature, {_r('value')} AS value FROM features",
        "tfidf_titles": f"SELECT item_id, term, {_r('w')} AS w FROM tfidf",
        "user_profiles": f"""SELECT user_id, feature_no, {_r('coalesce(value, 0)')} AS value
          FROM (SELECT DISTINCT user_id FROM profiles) CROSS JOIN (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS feature_no
          FROM (SELECT DISTINCT feature FROM features)) LEFT JOIN profiles USING (user_id, feature)""",
        "similar_items": f"""SELECT item_id, rank, neighbour_id, cosine FROM (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY cosine DESC, neighbour_id) AS rank FROM (
            SELECT i.item_id, j.item_id AS neighbour_id, round(coalesce(c, 0), 9) + 0.0 AS cosine FROM items i CROSS JOIN items j
            LEFT JOIN cos_pairs ON a = i.item_id AND b = j.item_id WHERE i.item_id <> j.item_id)) WHERE rank <= 5""",
        "als_rank1_factors": f"SELECT 'user' AS side, id, {_r('v')} AS value FROM x2 UNION ALL SELECT 'item', id, {_r('v')} FROM y2",
        "als_rank1_fold_in": f"SELECT id AS request_id, {_r('v')} AS value FROM folded",
        "zscore_per_user": f"""SELECT user_id, item_id, {_r('z_cf')} AS z_cf, {_r('z_content')} AS z_content,
          {_r('z_popularity')} AS z_popularity FROM z SEMI JOIN ratings USING (user_id, item_id)""",
        "mmr_rerank": "SELECT user_id, picked::BIGINT AS rank, item_id FROM m10 WHERE picked > 0",
        "ranking_metrics": "SELECT model, user_id, n_relevant, n_train, " + ", ".join(
            f"{_r(f'{m}_{k}')} AS {m}_{k}" for k in (5, 10, 20) for m in ("precision", "recall", "ndcg", "hit")) + " FROM frame",
        "hit_flags": """SELECT model, rank, count(*) FILTER (WHERE hit) AS hits, count(*) AS rows FROM lists WHERE rank <= 10
          GROUP BY 1, 2""",
        "beyond_accuracy": f"""SELECT model, users, {_r('coverage')} AS coverage, {_r('novelty')} AS novelty,
          {_r('diversity')} AS diversity FROM summary WHERE slice = '{metrics.ALL}'""",
        "slice_metrics": f"SELECT slice, model, users, {_METRIC_COLUMNS} FROM summary WHERE slice <> '{cold_item}'",
        "cold_item_slice": f"SELECT model, users, {_METRIC_COLUMNS} FROM summary WHERE slice = '{cold_item}'",
        "robustness_table": f"""SELECT model, {_r('all_users')} AS all_users, {_r('warm_users')} AS warm_users,
            {_r('cold_users')} AS cold_users, {_r('cold_items')} AS cold_items, {_r('''least(warm_users / max(warm_users) OVER (),
            cold_users / max(cold_users) OVER (), cold_items / max(cold_items) OVER ())''')} AS worst_vs_best FROM (
          SELECT model, max(ndcg) FILTER (WHERE slice = '{metrics.ALL}') AS all_users,
            max(ndcg) FILTER (WHERE slice = '{metrics.warm_slice(5)}') AS warm_users,
            max(ndcg) FILTER (WHERE slice = '{metrics.cold_slice(5)}') AS cold_users,
            max(ndcg) FILTER (WHERE slice = '{cold_item}') AS cold_items FROM summary
          WHERE model IN (SELECT model FROM summary WHERE slice = '{cold_item}') GROUP BY 1)""",
        "geo_mean_objective": f"""SELECT model, {_r('exp(avg(ln(greatest(ndcg, 1e-9))))')} AS objective FROM summary
          WHERE slice IN ('{metrics.warm_slice(5)}', '{metrics.cold_slice(5)}', '{cold_item}') GROUP BY 1""",
        "model_lift": f"""SELECT slice, m.model, CASE WHEN b.ndcg > 0 THEN round((m.ndcg / b.ndcg - 1) * 100)::BIGINT END AS lift
          FROM (SELECT slice, model, round(ndcg, 6) AS ndcg FROM summary) m
          JOIN (SELECT slice, round(ndcg, 6) AS ndcg FROM summary WHERE model = '{scorer.POPULARITY}') b USING (slice)""",
        "dataset_facts": """SELECT (SELECT count(*) FROM user_stats) AS users, (SELECT count(*) FROM item_stats) AS items,
          (SELECT count(*) FROM cold_ids) AS cold_items, (SELECT count(*) FROM split WHERE in_train) AS train_ratings,
          (SELECT count(*) FROM split WHERE NOT in_train) AS test_ratings, (SELECT count(*) FROM eval_users) AS eval_users,
          (SELECT count(*) FROM eval_users WHERE n_train < 5) AS cold_eval_users,
          (SELECT count(*) FROM cold_eval_users) AS cold_item_eval_users""",
        "ndcg_by_history": f"""SELECT bucket_no, history, count(DISTINCT user_id) AS users, """ + ", ".join(
            f"{_r(f'''avg(ndcg_10) FILTER (WHERE model = '{m}')''')} AS \"{m}\"" for m in analysis.HISTORY_MODELS) + f"""
          FROM (VALUES {_HISTORY_ROWS}) b(bucket_no, history, n_mid) LEFT JOIN
          (SELECT *, {_HISTORY.format(n='n_train')} AS history FROM frame) USING (history) GROUP BY 1, 2""",
        "mainstream_quintiles": f"""SELECT quintile, count(*) AS users, {_r('avg(mainstream)')} AS mainstream,
          {_r('avg(ndcg_10)')} AS ndcg, {_r('avg(recall_10)')} AS recall FROM (SELECT *, 1 + (mainstream > e[1])::BIGINT
          + (mainstream > e[2])::BIGINT + (mainstream > e[3])::BIGINT + (mainstream > e[4])::BIGINT AS quintile
          FROM warm_adaptive CROSS JOIN edges) GROUP BY 1""",
        "popularity_bias": f"""SELECT model, any_value(hn) AS head_items, any_value(tn) AS tail_items,
            {_r('sum(hit::BIGINT) FILTER (WHERE is_head) / greatest(any_value(hr), 1)')} AS recall_head,
            {_r('sum(hit::BIGINT) FILTER (WHERE NOT is_head) / greatest(any_value(tr), 1)')} AS recall_tail,
            {_r('avg(is_head::BIGINT)')} AS share_of_recs_from_head,
            {_r('any_value(hr) / (any_value(hr) + any_value(tr))::DOUBLE')} AS share_of_relevant_in_head
          FROM lists JOIN head USING (item_id) CROSS JOIN (SELECT count(*) FILTER (WHERE is_head) AS hn,
            count(*) FILTER (WHERE NOT is_head) AS tn, coalesce(sum(relevant) FILTER (WHERE is_head), 0) AS hr,
            coalesce(sum(relevant) FILTER (WHERE NOT is_head), 0) AS tr FROM head LEFT JOIN item_relevant USING (item_id))
          WHERE rank <= 10 AND model IN ('{scorer.DEMOGRAPHIC}', '{scorer.CF}', '{scorer.ADAPTIVE}', '{scorer.MMR}') GROUP BY 1""",
        "genre_recall": f"""SELECT genre, relevant AS relevant_pairs, {_r('hits / relevant::DOUBLE')} AS recall,
            {_r('relevant / (sum(relevant) OVER ())::DOUBLE')} AS share_of_relevant,
            {_r('recommended / (sum(recommended) OVER ())::DOUBLE')} AS share_of_recommendations FROM (
          SELECT genre, sum(coalesce(relevant, 0))::BIGINT AS relevant, sum(coalesce(hits, 0))::BIGINT AS hits,
            sum(coalesce(recommended, 0))::BIGINT AS recommended FROM (SELECT item_id, unnest(genres) AS genre FROM items)
          LEFT JOIN item_relevant USING (item_id) LEFT JOIN (SELECT item_id, count(*) AS recommended, count(*) FILTER (WHERE hit) AS hits
            FROM lists WHERE model = '{scorer.ADAPTIVE}' AND rank <= 10 GROUP BY 1) USING (item_id) GROUP BY 1)
          QUALIFY relevant >= 200""",
        "cold_user_rating_bands": f"""SELECT CASE WHEN m <= 2.99 THEN 'mostly dislikes (<3)' WHEN m <= 3.99 THEN 'lukewarm (3-4)'
            ELSE 'mostly likes (>=4)' END AS band, count(*) AS users, {_r('avg(ndcg_10)')} AS ndcg
          FROM frame JOIN (SELECT user_id, avg(rating) AS m FROM train GROUP BY 1) USING (user_id)
          WHERE model = '{scorer.ADAPTIVE}' AND n_train BETWEEN 1 AND 4 GROUP BY 1""",
        "recommend_new_users": f"""SELECT user_id AS request_id, n_user AS history_size, rank, item_id, score,
            {_r(f'({_WEIGHTS["adaptive"][0]}) * z_cf')} AS cf, {_r(f'({_WEIGHTS["adaptive"][1]}) * z_content')} AS content,
            {_r(f'({_WEIGHTS["adaptive"][2]}) * z_popularity')} AS popularity, {_r(_WEIGHTS["adaptive"][0])} AS w_cf,
            {_r(_WEIGHTS["adaptive"][1])} AS w_content, {_r(_WEIGHTS["adaptive"][2])} AS w_popularity FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM (
            SELECT *, round({_blend('adaptive')}, 9) + 0.0 AS score FROM new_z
            WHERE (user_id, item_id) NOT IN (SELECT request_id, item_id FROM new_pairs))) WHERE rank <= 10""",
        "hybrid_explain": f"""SELECT user_id, rank, item_id, score, hit,
            {_r(f'({_WEIGHTS["adaptive"][0]}) * z_cf')} AS cf, {_r(f'({_WEIGHTS["adaptive"][1]}) * z_content')} AS content,
            {_r(f'({_WEIGHTS["adaptive"][2]}) * z_popularity')} AS popularity, {_r(_WEIGHTS["adaptive"][0])} AS w_cf,
            {_r(_WEIGHTS["adaptive"][1])} AS w_content, {_r(_WEIGHTS["adaptive"][2])} AS w_popularity
          FROM lists JOIN (SELECT user_id, item_id, n_user, z_cf, z_content, z_popularity FROM z) USING (user_id, item_id)
          WHERE model = '{scorer.ADAPTIVE}' AND rank <= 10""",
        "catalog_search": """SELECT query, rank, item_id, title, n_item FROM (SELECT query, item_id, title, n_item,
            row_number() OVER (PARTITION BY query ORDER BY n_item DESC, item_id) AS rank
          FROM (SELECT DISTINCT unnest([split_part(p_name, ' ', 1), upper(substr(p_name, 2, 4)), substr(p_name, 1, 1)]) AS query
            FROM part) JOIN items ON length(trim(query)) >= 2 AND contains(lower(title), lower(trim(query)))
          JOIN item_stats USING (item_id)) WHERE rank <= 8""",
        "user_history_top": f"""SELECT user_id, rank, item_id, title, {_r('rating')} AS rating, n_item FROM (SELECT *,
          row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank FROM train)
          JOIN items USING (item_id) JOIN item_stats USING (item_id) WHERE rank <= 40""",
        "user_summary": f"""SELECT user_id, n_user AS n_ratings, coalesce(n, 0) AS liked_later, gender,
          CASE age {' '.join(f"WHEN {k} THEN '{v}'" for k, v in buckets.AGE_LABELS.items())} ELSE '' END AS age
          FROM user_stats LEFT JOIN (SELECT user_id, count(*) AS n FROM liked GROUP BY 1) USING (user_id)
          LEFT JOIN users USING (user_id)""",
        "example_users": _EXAMPLES,
        "dataset_meta": f"""SELECT 'tables' AS dataset, (SELECT count(*) FROM user_stats) AS users, count(*) AS items,
          sum(n_item)::BIGINT AS train_ratings, true AS demographics, 30.0::DOUBLE AS k_user, 300.0::DOUBLE AS k_item,
          30.0::DOUBLE AS k_content, '{' | '.join(sorted(serving.MODEL_KEYS))}' AS models,
          '{' | '.join(f"{k} {v}" for k, v in sorted(buckets.AGE_LABELS.items()))}' AS age_groups,
          (SELECT string_agg(label || ' ' || user_id || ' ' || ratings, ' | ' ORDER BY ratings, label) FROM ({_EXAMPLES})) AS examples FROM item_stats""",
        "request_validation": "SELECT request_id, errors = '' AS valid, errors FROM checked",
    }
    both = lambda name: f"SELECT id, 0 AS dim, p AS v FROM {name} UNION ALL SELECT id, 1, q FROM {name}"
    out["als_rank2_factors"] = f"""SELECT side, id, dim::BIGINT AS dim, {_r('v')} AS value FROM (
      SELECT 'user' AS side, * FROM ({both('a2')}) UNION ALL SELECT 'item', * FROM ({both('b2')}))"""
    out["als_rank2_fold_in"] = f"SELECT id AS request_id, dim::BIGINT AS dim, {_r('v')} AS value FROM ({both('folded2')})"
    out["als_gram"] = " UNION ALL ".join(
        f"SELECT '{side}' AS side, {i}::BIGINT AS \"row\", {j}::BIGINT AS col, count(*) AS vectors, {_r(f'sum({x} * {y})')} AS gram FROM {name}"
        for side, name in (("user", "a2"), ("item", "b2")) for i, x in enumerate("pq") for j, y in enumerate("pq"))
    out["topk_als_rank2"] = """SELECT user_id, rank, item_id, score, l.user_id IS NOT NULL AS hit FROM rank2_lists
      LEFT JOIN liked l USING (user_id, item_id) WHERE rank <= 10"""
    out["blend_grid"] = f"""SELECT k_user, k_item, k_content, {_r('warm_users')} AS warm_users, {_r('cold_users')} AS cold_users,
      {_r('cold_items')} AS cold_items, {_r("""exp((ln(greatest(warm_users, 1e-9)) + ln(greatest(cold_users, 1e-9))
      + ln(greatest(cold_items, 1e-9))) / 3)""")} AS objective FROM grid_slices JOIN grid_cold_slice USING (k_user, k_item, k_content)"""
    out["content_ablation"] = f"""SELECT name AS content_features, {_r('ndcg')} AS ndcg FROM (
      SELECT unnest(['all blocks', 'without title/tag text']) AS name, avg(ndcg_10) AS ndcg FROM cold_frame WHERE model = '{scorer.CONTENT}'
      UNION ALL SELECT unnest(['genres only', 'without decade']), avg(ndcg) FROM genre_only_frame)"""
    out["case_studies"] = f"""SELECT user_id, n_relevant AS liked_count, history, recommended, actually_liked FROM worst
      LEFT JOIN (SELECT user_id, string_agg(shown || ' - ' || rating::BIGINT || ' stars', ' | ' ORDER BY item_id) AS history
        FROM train JOIN shown USING (item_id) SEMI JOIN worst USING (user_id) GROUP BY 1) USING (user_id)
      LEFT JOIN (SELECT user_id, string_agg(shown, ' | ' ORDER BY rank) AS recommended FROM lists JOIN shown USING (item_id)
        WHERE model = '{scorer.ADAPTIVE}' AND rank <= 5 GROUP BY 1) USING (user_id)
      LEFT JOIN (SELECT user_id, string_agg(shown, ' | ' ORDER BY rank) AS actually_liked FROM liked_ranked JOIN shown USING (item_id)
        WHERE rank <= 5 GROUP BY 1) USING (user_id)"""
    out["hardest_cold_items"] = f"""SELECT item_id, shown AS title, array_to_string(genres, ', ') AS genres, n_item AS train_ratings,
        fans_in_test, {_r('hit_rate')} AS hit_rate, near AS nearest_by_content FROM hardest JOIN shown USING (item_id)
      JOIN items USING (item_id) JOIN item_stats USING (item_id) JOIN nearest USING (item_id)"""
    out["als_grid"] = " UNION ALL ".join(_point_sums)
    out["custom_scorer_topk"] = f"""SELECT model, user_id, rank, item_id, score, l.user_id IS NOT NULL AS hit FROM (
        SELECT 'Price' AS model, user_id, place AS rank, item_id, score FROM price_lists WHERE place <= 10
        UNION ALL SELECT 'Price, two per decade', user_id, place, item_id, score FROM price_mixed WHERE place <= 10
        UNION ALL SELECT model, user_id, rank, item_id, score FROM lists WHERE model = '{scorer.POPULARITY}' AND rank <= 10) b
      LEFT JOIN liked l USING (user_id, item_id)"""
    out["lsa_rank2_embedding"] = f"""SELECT item_id, {_r('abs(sum(w * a.v))')} AS first, {_r('abs(sum(w * b.v))')} AS second
      FROM tfidf JOIN leaddir a USING (term) JOIN nextdir b USING (term) GROUP BY 1"""
    titles = r"""SELECT p_partkey AS item_id, CASE p_partkey % 6 WHEN 0 THEN nm || ', The' || yr WHEN 1 THEN '  ' || nm || yr
        WHEN 2 THEN nm || ', A' WHEN 3 THEN nm || ', An (also, The)' || yr WHEN 4 THEN nm || ' (alias)' || yr || '  '
        ELSE nm END AS raw FROM (SELECT p_partkey, ' (' || (1950 + p_size) || ')' AS yr, array_to_string(
          list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS nm FROM part)"""
    out["title_year_split"] = rf"""SELECT item_id, regexp_replace(CASE WHEN instr(body, ' (') > 0
          THEN substr(body, 1, instr(body, ' (') - 1) ELSE body END, '^(.*), ({text.ARTICLES})$', '\2 \1')
        || CASE WHEN instr(body, ' (') > 0 THEN substr(body, instr(body, ' (')) ELSE '' END AS title, year::BIGINT AS year
      FROM (SELECT item_id, regexp_replace(trim(raw), '\s*\(\d{{4}}\)$', '') AS body,
        nullif(regexp_extract(trim(raw), '\((\d{{4}})\)$', 1), '') AS year FROM ({titles}))"""
    out["genre_parse"] = """SELECT item_id, len(g) AS n, genre FROM (SELECT p_partkey AS item_id,
        CASE WHEN p_partkey % 9 = 0 THEN [] ELSE [p_type, p_brand] END AS g FROM part)
      LEFT JOIN LATERAL (SELECT unnest(g) AS genre) ON true"""
    best = ", ".join(f"round({m}, 9) = max(round({m}, 9)) OVER (PARTITION BY slice) AS best_{m}" for m in ("precision", "recall", "ndcg", "hit", "coverage", "novelty", "diversity"))
    out["best_models"] = f"SELECT slice, model, {best} FROM summary"
    done = {name: with_parts(sql) for name, sql in out.items()}
    done["adaptive_weights"] = _weights_sql("adaptive")
    done["switch_weights"] = _weights_sql("switch")
    done["user_mean_weights"] = _mean_weights("n_user", "user_stats", "user_id, n_user")
    done["weights_by_history"] = _mean_weights("n_mid", f"(VALUES {_HISTORY_ROWS}) b(bucket_no, history, n_mid)",
                                               "bucket_no, history, n_mid").replace("SELECT bucket_no, history, n_mid,", "SELECT bucket_no, history,")
    from coldspring.checks.queries import _LISTS
    done.update({name: _top_list(model) for name, model in _LISTS.items()})
    done["topk_content_sparse"] = done["topk_content"]
    return done
