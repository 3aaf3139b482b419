"""Lexicon scores and labels, checked against the same rules written as SQL over word rows."""

from pyspark.sql import functions as F

from chatterlens import schemas as S
from chatterlens.functions import lexicon as X
from chatterlens.operators import sentiment as L
from chatterlens.plans import tables as D
from chatterlens.plans.registry import query

# The texts hold few lexicon words, so phrases that touch every rule are worked in.
PHRASES = [
    "This is GREAT, but the end was bad!!", "not very good", "kind of good and sort of nice", "I HATE it!!!!! no joy",
    "never so happy", "without a doubt great", "the least helpful", "at least fun?", "no or love", "really really bad??",
    "yeah right, perfect", "it is to die for, super", "isn't awful", "kiss of death and war ????", "barely fine",
]
_ROWS = "\n".join(f"WHEN {i} THEN {D.quoted(p).replace(chr(39) * 2, chr(92) + chr(39))}" for i, p in enumerate(PHRASES))
_DUCK_ROWS = "\n".join(f"WHEN {i} THEN {D.quoted(p)}" for i, p in enumerate(PHRASES))
_BODY = "concat(CASE CAST(id AS BIGINT) % {n} {rows} ELSE '' END, ' ', body)"


def spoken(spark, sf_dir):
    return D.comments(spark, sf_dir).withColumn(
        "body", F.expr(_BODY.format(n=len(PHRASES) + 1, rows=_ROWS))
    )


_LIST = lambda words: "(" + ", ".join(D.quoted(w) for w in words) + ")"
_PUNCT = D.quoted(X.PUNCTUATION)
_LEX, _BOOST, _IDIOM = D.duck_map(X.LEXICON), D.duck_map(X.BOOSTERS), D.duck_map(X.IDIOMS)


def _lookup(entries: str, key: str) -> str:
    return f"map_extract_value({entries}, {key})"


_LAGS = ",\n  ".join(
    f"lag({c}, {k}) OVER w AS {c}{k}" for k in (1, 2, 3) for c in ("low", "up", "lex", "boost", "neg")
)


def _step(k: int) -> str:
    """SQL for the look-back at distance k, on top of the running valence v{k-1}."""
    sign = f"CASE WHEN v{k - 1} < 0 THEN -boost{k} ELSE boost{k} END"
    loud = f"CASE WHEN up{k} AND shouting THEN (CASE WHEN v{k - 1} > 0 THEN {X.CAPS} ELSE -{X.CAPS} END) ELSE 0 END"
    boosted = f"(v{k - 1} + coalesce(({sign} + {loud}) * {X.DAMPED[k]}, 0))"
    flipped = f"CASE WHEN neg{k} THEN b * {X.NEGATED} ELSE b END"
    if k == 2:
        flipped = f"CASE WHEN low2 = 'never' AND low1 IN ('so', 'this') THEN b * 1.25 WHEN low2 = 'without' AND low1 = 'doubt' THEN b ELSE {flipped} END"
    if k == 3:
        flipped = f"CASE WHEN low3 = 'never' AND (low2 IN ('so', 'this') OR low1 IN ('so', 'this')) THEN b * 1.25 WHEN low3 = 'without' AND (low2 = 'doubt' OR low1 = 'doubt') THEN b ELSE {flipped} END"
        spans = ["low || ' ' || next1 || ' ' || next2", "low || ' ' || next1", "low1 || ' ' || low",
                 "low2 || ' ' || low1 || ' ' || low", "low2 || ' ' || low1", "low3 || ' ' || low2 || ' ' || low1", "low3 || ' ' || low2"]
        phrases = ", ".join(_lookup(_IDIOM, s) for s in spans)
        lowered = " + ".join(
            f"CASE WHEN {s} IN {_LIST(X.BOOSTER_PHRASES)} THEN -{X.BOOST} ELSE 0 END"
            for s in ("low3 || ' ' || low2 || ' ' || low1", "low3 || ' ' || low2", "low2 || ' ' || low1"))
        flipped = f"coalesce({phrases}, {flipped}) + {lowered}"
    return f"""s{k} AS (SELECT * EXCLUDE (b), CASE WHEN place > {k} AND lex{k} IS NULL THEN {flipped} ELSE v{k - 1} END AS v{k}
      FROM (SELECT *, {boosted} AS b FROM {'s0' if k == 1 else f's{k - 1}'}))"""


SCORED_CTE = f"""{D.COMMENTS_CTE},
spoken AS (SELECT * REPLACE ({_BODY.format(n=len(PHRASES) + 1, rows=_DUCK_ROWS)} AS body) FROM comments),
pieces AS (SELECT id, unnest({D.duck_words('body')}) AS piece, generate_subscripts({D.duck_words('body')}, 1) AS place FROM spoken),
words AS (SELECT id, place, CASE WHEN length(trim(piece, {_PUNCT})) <= 2 THEN piece ELSE trim(piece, {_PUNCT}) END AS word FROM pieces),
marked AS (SELECT id, place, lower(word) AS low, upper(word) = word AND lower(word) <> word AS up,
  {_lookup(_LEX, 'lower(word)')} AS lex, {_lookup(_BOOST, 'lower(word)')} AS boost,
  lower(word) IN {_LIST(X.NEGATIONS)} OR contains(lower(word), 'n''t') AS neg FROM words),
near AS (SELECT *, {_LAGS},
  lead(low, 1) OVER w AS next1, lead(low, 2) OVER w AS next2, lead(lex, 1) OVER w AS next_lex,
  bool_or(up) OVER d AND bool_or(NOT up) OVER d AS shouting,
  min(CASE WHEN low = 'but' THEN place END) OVER d AS but_at
  FROM marked WINDOW w AS (PARTITION BY id ORDER BY place), d AS (PARTITION BY id)),
own AS (SELECT *, CASE WHEN low1 = 'no' OR low2 = 'no' OR (low3 = 'no' AND low1 IN ('or', 'nor')) THEN lex * {X.NEGATED}
    WHEN low = 'no' AND next_lex IS NOT NULL THEN 0.0 ELSE lex END AS raw FROM near WHERE lex IS NOT NULL),
s0 AS (SELECT *, CAST(CASE WHEN up AND shouting THEN raw + (CASE WHEN raw > 0 THEN {X.CAPS} ELSE -{X.CAPS} END) ELSE raw END AS DOUBLE) AS v0 FROM own),
{_step(1)},
{_step(2)},
{_step(3)},
valued AS (SELECT id, place, but_at, CASE WHEN boost IS NOT NULL OR (low = 'kind' AND next1 IS NOT DISTINCT FROM 'of') THEN 0.0
    WHEN low1 = 'least' AND lex1 IS NULL AND NOT coalesce(low2 IN ('at', 'very'), false) THEN v3 * {X.NEGATED} ELSE v3 END AS v FROM s3),
summed AS (SELECT id, sum(v * CASE WHEN but_at IS NULL OR place = but_at THEN 1.0 WHEN place < but_at THEN 0.5 ELSE 1.5 END) AS total
  FROM valued GROUP BY id),
amplified AS (SELECT p.*, coalesce(total, 0.0) AS total, least(length(body) - length(replace(body, '!', '')), 4) * {X.EXCLAIM}
   + CASE WHEN q > 3 THEN {X.QUESTION_MAX} WHEN q > 1 THEN q * {X.QUESTION} ELSE 0 END AS amp
  FROM (SELECT *, length(body) - length(replace(body, '?', '')) AS q FROM spoken) p LEFT JOIN summed USING (id)),
emphasised AS (SELECT *, CAST(total + sign(total) * amp AS DOUBLE) AS s FROM amplified),
scored AS (SELECT *, round(s / sqrt(s * s + 15), 4) AS compound FROM emphasised)"""
_LABEL = "CASE WHEN compound >= 0.1 THEN 'positive' WHEN compound <= -0.1 THEN 'negative' ELSE 'neutral' END"


@query("lexicon_base", f"""WITH {D.COMMENTS_CTE}, summed AS (SELECT id, list_sum(list_transform({D.duck_words('body')},
      lambda w: coalesce({_lookup(_LEX, f"lower(CASE WHEN length(trim(w, {_PUNCT})) <= 2 THEN w ELSE trim(w, {_PUNCT}) END)")}, 0.0))) AS s
    FROM comments) SELECT id, round(CAST(coalesce(s, 0) / sqrt(s * s + 15) AS DOUBLE), 6) AS score FROM summed""")
def _base(spark, sf_dir):
    return D.comments(spark, sf_dir).select("id", F.round(X.lexicon_base(F.col("body")), 6).alias("score"))


@query("lexicon_compound", f"WITH {SCORED_CTE} SELECT id, compound FROM scored")
def _compound(spark, sf_dir):
    return spoken(spark, sf_dir).select("id", X.lexicon_compound(F.col("body")).alias("compound"))


@query("threshold_label", f"WITH {SCORED_CTE} SELECT id, {_LABEL} AS label FROM scored")
def _threshold_label(spark, sf_dir):
    return spoken(spark, sf_dir).select("id", X.threshold_label(X.lexicon_compound(F.col("body"))).alias("label"))


@query("label_batch", f"""WITH {SCORED_CTE} SELECT id, created_utc, subreddit, body, {_LABEL} AS label, score,
    controversiality FROM scored""")
def _label_batch(spark, sf_dir):
    return L.label_batch(spoken(spark, sf_dir))


@query("threshold_sweep", f"""WITH {SCORED_CTE}, swept AS (SELECT CAST(t AS DOUBLE) AS threshold,
      count(*) FILTER (WHERE compound >= t) AS pos, count(*) FILTER (WHERE compound <= -t) AS neg,
      count(*) FILTER (WHERE compound < t AND compound > -t) AS neu
      FROM scored, (VALUES {", ".join(f"({t}::DOUBLE)" for t in S.THRESHOLDS)}) x(t) GROUP BY t)
    SELECT *, {", ".join(f"round({n} / (pos + neg + neu), 6) AS {n}_share" for n in ("pos", "neg", "neu"))} FROM swept""")
def _sweep(spark, sf_dir):
    scored = spoken(spark, sf_dir).select(X.lexicon_compound(F.col("body")).alias("compound"))
    return L.threshold_sweep(scored).withColumns(
        {f"{n}_share": F.round(f"{n}_share", 6) for n in ("pos", "neg", "neu")}
    )
