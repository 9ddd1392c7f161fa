"""Independent DuckDB SQL for every registered query with a SQL equivalent.

Written by hand against the driver's views (``orders``, ``customer``,
``events``), with the portfolio views inlined as CTEs. Notes on dialect
agreement with Spark:

* ``365.25e0``, ``0.75e0``: double literals (a bare ``365.25`` is DECIMAL in
  DuckDB).
* Spark's ascending order puts nulls first; DuckDB's default is last, so the
  window states ``NULLS FIRST``.
* DuckDB casts double -> integer by rounding; Spark truncates, hence
  ``trunc`` before the cast.
* Spark ``bround`` = DuckDB ``round_even``.
"""

from __future__ import annotations

from ..schema import CATEGORICAL_COLS, NUMERIC_COLS
from ..sources.fixtures import (duckdb_applications_cte, duckdb_bodies_cte,
                                duckdb_feedback_cte, duckdb_identities_cte, duckdb_odd_amounts,
                                duckdb_prepared_select, duckdb_scored_ctes,
                                duckdb_unusual_cte)

_APPS = "WITH " + duckdb_applications_cte()
_SCORED = "WITH " + duckdb_scored_ctes()
_RATE = "round(avg(CASE WHEN TARGET = 1 THEN 1 ELSE 0 END) * 100, 2) AS DEFAULT_RATE"

_AGE = """
SELECT AGE_GROUP, count(*) AS CLIENT_COUNT, {rate}
FROM (
  SELECT TARGET,
         CASE WHEN -DAYS_BIRTH / 365.25e0 < 25 THEN '< 25 ans'
              WHEN -DAYS_BIRTH / 365.25e0 < 35 THEN '25-35 ans'
              WHEN -DAYS_BIRTH / 365.25e0 < 45 THEN '35-45 ans'
              WHEN -DAYS_BIRTH / 365.25e0 < 55 THEN '45-55 ans'
              ELSE '> 55 ans' END AS AGE_GROUP
  FROM applications
) t
GROUP BY AGE_GROUP
"""

_TILES = """
SELECT SK_ID_CURR, round(AMT_CREDIT / NULLIF(AMT_INCOME_TOTAL, 0), 2) AS CREDIT_INCOME_RATIO,
       CAST(ntile(5) OVER (ORDER BY round(AMT_CREDIT / NULLIF(AMT_INCOME_TOTAL, 0), 2) ASC NULLS FIRST,
                           SK_ID_CURR ASC) AS INTEGER) AS RATIO_CATEGORY
FROM applications
"""
_ODD_TILES = """,
odd AS ({odd}),
tiles AS (SELECT *, CAST(ntile(7) OVER (ORDER BY AMT_CREDIT ASC NULLS FIRST, SK_ID_CURR ASC) AS INTEGER) AS TILE FROM odd)
"""

_QUINTILE = """,
base AS (
  SELECT SK_ID_CURR, TARGET,
         round(AMT_CREDIT / NULLIF(AMT_INCOME_TOTAL, 0), 2) AS CREDIT_INCOME_RATIO
  FROM applications {where}
),
tiles AS (
  SELECT *, ntile(5) OVER (ORDER BY CREDIT_INCOME_RATIO ASC NULLS FIRST, SK_ID_CURR ASC) AS q
  FROM base
)
SELECT CAST(q AS INTEGER) AS RATIO_CATEGORY, count(*) AS COUNT,
       round(avg(CREDIT_INCOME_RATIO), 2) AS AVG_RATIO, {rate}
FROM tiles GROUP BY q
"""

_INCOME = """
SELECT NAME_INCOME_TYPE, count(*) AS CLIENT_COUNT,
       round(avg(AMT_INCOME_TOTAL), 0) AS AVG_INCOME, {rate}
FROM applications {where}
GROUP BY NAME_INCOME_TYPE
HAVING count(*) > 100
"""

_EMPLOYMENT = """
SELECT EMPLOYMENT_LENGTH, count(*) AS CLIENT_COUNT, {rate}
FROM (
  SELECT TARGET,
         CASE WHEN y < 1 THEN '< 1 an' WHEN y < 3 THEN '1-3 ans' WHEN y < 5 THEN '3-5 ans'
              WHEN y < 10 THEN '5-10 ans' ELSE '> 10 ans' END AS EMPLOYMENT_LENGTH
  FROM (SELECT TARGET,
               CASE WHEN DAYS_EMPLOYED = 365243 THEN 0e0 ELSE -DAYS_EMPLOYED / 365.25e0 END AS y
        FROM applications) e
) t
GROUP BY EMPLOYMENT_LENGTH
"""

_ENQUIRY = """
SELECT ENQUIRY_GROUP, count(*) AS CLIENT_COUNT, {rate}
FROM (
  SELECT TARGET,
         CASE WHEN n = 0 THEN 'Aucune demande' WHEN n <= 2 THEN '1-2 demandes'
              WHEN n <= 5 THEN '3-5 demandes' WHEN n <= 10 THEN '6-10 demandes'
              ELSE '> 10 demandes' END AS ENQUIRY_GROUP
  FROM (SELECT TARGET,
               coalesce(AMT_REQ_CREDIT_BUREAU_HOUR, 0) + coalesce(AMT_REQ_CREDIT_BUREAU_DAY, 0)
             + coalesce(AMT_REQ_CREDIT_BUREAU_WEEK, 0) + coalesce(AMT_REQ_CREDIT_BUREAU_MON, 0)
             + coalesce(AMT_REQ_CREDIT_BUREAU_QRT, 0) + coalesce(AMT_REQ_CREDIT_BUREAU_YEAR, 0) AS n
        FROM applications) e
) t
GROUP BY ENQUIRY_GROUP
"""

_CONTRACT_GROUPS = """
SELECT NAME_CONTRACT_TYPE,
       CASE FLAG_OWN_REALTY WHEN 'Y' THEN 'Propriétaire' WHEN 'N' THEN 'Non propriétaire' END
         AS FLAG_OWN_REALTY,
       count(*) AS CLIENT_COUNT, round(avg(AMT_CREDIT), 0) AS AVG_CREDIT, {rate}
FROM applications
GROUP BY NAME_CONTRACT_TYPE, applications.FLAG_OWN_REALTY
"""

_FAMILY_GROUPS = """
SELECT NAME_FAMILY_STATUS, CNT_CHILDREN, count(*) AS CLIENT_COUNT, {rate}
FROM applications
GROUP BY NAME_FAMILY_STATUS, CNT_CHILDREN
HAVING count(*) > 50
"""

_WEEKDAY = """
SELECT WEEKDAY_APPR_PROCESS_START, count(*) AS APPLICATION_COUNT, {rate},
       round(avg(AMT_CREDIT), 0) AS AVG_CREDIT,
       CAST(CASE WHEN WEEKDAY_APPR_PROCESS_START IS NULL THEN 0
                 ELSE CASE upper(WEEKDAY_APPR_PROCESS_START)
                        WHEN 'MONDAY' THEN 0 WHEN 'TUESDAY' THEN 1 WHEN 'WEDNESDAY' THEN 2
                        WHEN 'THURSDAY' THEN 3 WHEN 'FRIDAY' THEN 4 WHEN 'SATURDAY' THEN 5
                        WHEN 'SUNDAY' THEN 6 END END AS INTEGER) AS WEEKDAY_ORDER
FROM applications
GROUP BY WEEKDAY_APPR_PROCESS_START
"""

_CONTRACT_MATRIX = """,
g AS ({groups})
SELECT NAME_CONTRACT_TYPE,
       max(CASE WHEN FLAG_OWN_REALTY = 'Propriétaire' THEN DEFAULT_RATE END) AS "Propriétaire",
       max(CASE WHEN FLAG_OWN_REALTY = 'Non propriétaire' THEN DEFAULT_RATE END) AS "Non propriétaire"
FROM g GROUP BY NAME_CONTRACT_TYPE
"""

_FAMILY_MATRIX = """,
g AS ({groups})
SELECT CNT_CHILDREN,
       sum(CASE WHEN NAME_FAMILY_STATUS = 'Married' THEN DEFAULT_RATE END) AS "Married",
       sum(CASE WHEN NAME_FAMILY_STATUS = 'Single / not married' THEN DEFAULT_RATE END) AS "Single / not married",
       sum(CASE WHEN NAME_FAMILY_STATUS = 'Civil marriage' THEN DEFAULT_RATE END) AS "Civil marriage",
       sum(CASE WHEN NAME_FAMILY_STATUS = 'Separated' THEN DEFAULT_RATE END) AS "Separated",
       sum(CASE WHEN NAME_FAMILY_STATUS = 'Widow' THEN DEFAULT_RATE END) AS "Widow"
FROM g GROUP BY CNT_CHILDREN
"""

_FILTER = """
SELECT SK_ID_CURR, AMT_CREDIT, AMT_INCOME_TOTAL, TARGET
FROM applications
WHERE AMT_CREDIT >= 100000 AND AMT_CREDIT <= 300000
"""

_LOOKUP = """
SELECT CAST(i.id AS BIGINT) AS SK_ID_CURR, a.SK_ID_CURR IS NOT NULL AS found,
       a.AMT_CREDIT, a.NAME_CONTRACT_TYPE
FROM (VALUES (0), (1), (7), (97), (1499), (-1)) AS i(id)
LEFT JOIN applications a ON a.SK_ID_CURR = i.id
"""

_FALLBACK = """
SELECT SK_ID_CURR, prediction,
       CASE WHEN prediction > 0 THEN 0.75e0 ELSE 0.25e0 END AS risk_score
FROM scored
"""

_REPORT_COLS = """
  SK_ID_CURR AS client_id, CODE_GENDER AS gender,
  CAST(trunc(-DAYS_BIRTH / 365.25e0) AS INTEGER) AS age,
  CAST(trunc(CNT_CHILDREN) AS INTEGER) AS children_count,
  AMT_INCOME_TOTAL AS income, AMT_CREDIT AS credit_amount,
  NAME_INCOME_TYPE AS income_type, NAME_EDUCATION_TYPE AS education_type,
  NAME_FAMILY_STATUS AS family_status, NAME_HOUSING_TYPE AS housing_type,
  CASE WHEN DAYS_EMPLOYED IS NULL OR DAYS_EMPLOYED = 365243 THEN 0e0
       ELSE -DAYS_EMPLOYED / 365.25e0 END AS years_employed,
  risk_score, CAST(trunc(prediction) AS INTEGER) AS predicted_default
"""

_LEVEL = ("CASE WHEN risk_score IS NULL THEN NULL WHEN risk_score >= 0.70e0 THEN 'Élevé' "
          "WHEN risk_score >= 0.40e0 THEN 'Moyen' ELSE 'Faible' END")

_RECOMMEND = """,
lv AS (SELECT SK_ID_CURR, risk_score, {level} AS risk_level FROM scored)
SELECT SK_ID_CURR, risk_score, risk_level,
  CASE risk_level WHEN 'Élevé' THEN 'Refus recommandé'
                  WHEN 'Moyen' THEN 'Acceptation conditionnelle'
                  WHEN 'Faible' THEN 'Acceptation recommandée' END AS decision,
  CASE risk_level
    WHEN 'Élevé' THEN 'Le niveau de risque est trop élevé pour accorder le crédit aux conditions demandées.'
    WHEN 'Moyen' THEN 'Le dossier présente un risque modéré qui nécessite des garanties supplémentaires.'
    WHEN 'Faible' THEN 'Le profil présente un faible risque de défaut.' END AS explanation,
  CASE risk_level
    WHEN 'Élevé' THEN 'Proposer un montant réduit avec garanties supplémentaires.'
    WHEN 'Moyen' THEN 'Envisager un co-emprunteur ou une caution solidaire.'
    WHEN 'Faible' THEN 'Procéder à l''octroi du crédit aux conditions standards.' END AS alternative,
  CASE risk_level
    WHEN 'Élevé' THEN 'Refuser le crédit aux conditions demandées | Proposer un montant réduit (max 30% du revenu) | Exiger des garanties supplémentaires (caution, hypothèque) | Orienter le client vers un accompagnement budgétaire'
    WHEN 'Moyen' THEN 'Accepter sous réserve de garanties supplémentaires | Ajuster le taux d''intérêt pour compenser le risque | Proposer une durée d''emprunt plus courte | Mettre en place un suivi trimestriel'
    WHEN 'Faible' THEN 'Accorder le crédit aux conditions standards | Proposer des produits complémentaires (assurance, épargne) | Appliquer le processus de suivi standard | Réévaluer le risque annuellement' END AS action_plan
FROM lv
"""

_FORMAT_SELECT = """
SELECT client_id,
  CASE gender WHEN 'M' THEN 'Homme' WHEN 'F' THEN 'Femme' ELSE gender END AS gender,
  age, children_count,
  CAST(round_even(income, 0) AS BIGINT) AS income,
  CAST(round_even(credit_amount, 0) AS BIGINT) AS credit_amount,
  CASE income_type WHEN 'Working' THEN 'Salarié' WHEN 'Commercial associate' THEN 'Commercial'
    WHEN 'Pensioner' THEN 'Retraité' WHEN 'State servant' THEN 'Fonctionnaire'
    WHEN 'Entrepreneur' THEN 'Entrepreneur' ELSE income_type END AS income_type,
  CASE education_type WHEN 'Higher education' THEN 'Enseignement supérieur'
    WHEN 'Secondary / secondary special' THEN 'Secondaire'
    WHEN 'Incomplete higher' THEN 'Supérieur incomplet'
    WHEN 'Lower secondary' THEN 'Premier cycle secondaire'
    WHEN 'Academic degree' THEN 'Diplôme universitaire' ELSE education_type END AS education_type,
  CASE family_status WHEN 'Married' THEN 'Marié(e)' WHEN 'Single / not married' THEN 'Célibataire'
    WHEN 'Civil marriage' THEN 'Pacs' WHEN 'Separated' THEN 'Séparé(e)'
    WHEN 'Widow' THEN 'Veuf/veuve' ELSE family_status END AS family_status,
  CASE housing_type WHEN 'House / apartment' THEN 'Maison / appartement'
    WHEN 'Rented apartment' THEN 'Location' WHEN 'With parents' THEN 'Chez les parents'
    WHEN 'Municipal apartment' THEN 'Logement social'
    WHEN 'Office apartment' THEN 'Logement de fonction'
    WHEN 'Co-op apartment' THEN 'Coopérative' ELSE housing_type END AS housing_type,
  CASE WHEN years_employed > 100 THEN round_even(years_employed % 100, 1)
       ELSE round_even(years_employed, 1) END AS years_employed,
  risk_score, predicted_default
FROM r
"""

_FORMAT = ",\nr AS (SELECT {report} FROM scored)" + _FORMAT_SELECT

_RESPONSE = """,
r AS (SELECT {report} FROM scored),
f AS ({fmt}),
ids AS (SELECT CAST(id AS BIGINT) AS id FROM (VALUES (0), (1), (7), (97), (1499), (-1)) AS t(id))
SELECT i.id AS client_id, f.client_id IS NOT NULL AS found,
  CASE WHEN f.client_id IS NULL THEN printf('Client ID %d non trouvé dans les données', i.id) END AS error,
  f.gender, f.age, f.children_count, f.income, f.credit_amount, f.income_type,
  f.education_type, f.family_status, f.housing_type, f.years_employed,
  f.risk_score, f.predicted_default,
  {level} AS risk_level,
  CASE {level} WHEN 'Élevé' THEN 'Refus recommandé' WHEN 'Moyen' THEN 'Acceptation conditionnelle'
               WHEN 'Faible' THEN 'Acceptation recommandée' END AS decision,
  CASE WHEN f.client_id IS NOT NULL THEN strftime(TIMESTAMP '2024-06-03 14:05:00', '%d/%m/%Y') END AS analysis_date,
  CASE WHEN f.client_id IS NOT NULL THEN strftime(TIMESTAMP '2024-06-03 14:05:00', '%H:%M') END AS analysis_time,
  CASE WHEN f.client_id IS NOT NULL THEN '1.2.3' END AS version
FROM ids i LEFT JOIN f ON f.client_id = i.id
"""

_STAMP = """
SELECT SK_ID_CURR AS client_id,
  strftime(TIMESTAMP '2024-06-03 14:05:00', '%d/%m/%Y') AS analysis_date,
  strftime(TIMESTAMP '2024-06-03 14:05:00', '%H:%M') AS analysis_time,
  '1.2.3' AS version, 'Régression logistique' AS model_type,
  'Historique clients 2020-2024' AS data_source
FROM scored
"""

_DOSSIER = """,
{identities}
SELECT s.SK_ID_CURR AS client_id, i.client_name, i.photo_url, s.risk_score,
       {level} AS risk_level
FROM scored s LEFT JOIN identities i ON i.SK_ID_CURR = s.SK_ID_CURR
"""

_SEGMENT = """,
lv AS (SELECT SK_ID_CURR, NAME_INCOME_TYPE, NAME_CONTRACT_TYPE, risk_score,
              {level} AS risk_level FROM scored)
SELECT * FROM lv
WHERE NAME_INCOME_TYPE = 'Working' AND NAME_CONTRACT_TYPE = 'Cash loans'
  AND risk_level IN ('Élevé', 'Moyen')
"""

_SUMMARY = """
SELECT {level} AS risk_level, count(*) AS CLIENT_COUNT,
       round(avg(risk_score), 4) AS AVG_SCORE, round(sum(AMT_CREDIT), 2) AS TOTAL_CREDIT
FROM scored GROUP BY 1
"""

_FEEDBACK = """
SELECT event_id, coalesce(message, 'Message vide') AS message,
       CASE WHEN coalesce(is_positive, true) THEN 'INFO' ELSE 'ERROR' END AS level,
       json_extract_string(props, '$.k') AS k
FROM feedback
"""

_FEEDBACK_JSON = """
SELECT event_id, coalesce(message, 'Message vide') AS message,
       CASE WHEN coalesce(is_positive, true) THEN 'INFO' ELSE 'ERROR' END AS level,
       false AS malformed, json_extract_string(props, '$.k') AS k
FROM feedback
"""

_REPORT = """,
a AS (
  SELECT TARGET, AMT_INCOME_TOTAL, AMT_CREDIT, NAME_INCOME_TYPE, NAME_CONTRACT_TYPE,
         FLAG_OWN_REALTY, NAME_FAMILY_STATUS, CNT_CHILDREN, WEEKDAY_APPR_PROCESS_START,
         CASE WHEN -DAYS_BIRTH / 365.25e0 < 25 THEN '< 25 ans'
              WHEN -DAYS_BIRTH / 365.25e0 < 35 THEN '25-35 ans'
              WHEN -DAYS_BIRTH / 365.25e0 < 45 THEN '35-45 ans'
              WHEN -DAYS_BIRTH / 365.25e0 < 55 THEN '45-55 ans' ELSE '> 55 ans' END AS AGE_GROUP,
         CASE WHEN y < 1 THEN '< 1 an' WHEN y < 3 THEN '1-3 ans' WHEN y < 5 THEN '3-5 ans'
              WHEN y < 10 THEN '5-10 ans' ELSE '> 10 ans' END AS EMPLOYMENT_LENGTH,
         CASE WHEN n = 0 THEN 'Aucune demande' WHEN n <= 2 THEN '1-2 demandes'
              WHEN n <= 5 THEN '3-5 demandes' WHEN n <= 10 THEN '6-10 demandes'
              ELSE '> 10 demandes' END AS ENQUIRY_GROUP
  FROM (SELECT *,
          CASE WHEN DAYS_EMPLOYED = 365243 THEN 0e0 ELSE -DAYS_EMPLOYED / 365.25e0 END AS y,
          coalesce(AMT_REQ_CREDIT_BUREAU_HOUR, 0) + coalesce(AMT_REQ_CREDIT_BUREAU_DAY, 0)
        + coalesce(AMT_REQ_CREDIT_BUREAU_WEEK, 0) + coalesce(AMT_REQ_CREDIT_BUREAU_MON, 0)
        + coalesce(AMT_REQ_CREDIT_BUREAU_QRT, 0) + coalesce(AMT_REQ_CREDIT_BUREAU_YEAR, 0) AS n
        FROM applications) x
)
SELECT 1 AS ANALYSIS, AGE_GROUP AS KEY1, CAST(NULL AS VARCHAR) AS KEY2, count(*) AS CLIENT_COUNT,
       {rate}, CAST(NULL AS DOUBLE) AS AVG_INCOME, CAST(NULL AS DOUBLE) AS AVG_CREDIT,
       CAST(NULL AS INTEGER) AS WEEKDAY_ORDER
FROM a GROUP BY AGE_GROUP
UNION ALL
SELECT 3, NAME_INCOME_TYPE, NULL, count(*), {rate}, round(avg(AMT_INCOME_TOTAL), 0), NULL, NULL
FROM a GROUP BY NAME_INCOME_TYPE HAVING count(*) > 100
UNION ALL
SELECT 4, EMPLOYMENT_LENGTH, NULL, count(*), {rate}, NULL, NULL, NULL FROM a GROUP BY EMPLOYMENT_LENGTH
UNION ALL
SELECT 5, ENQUIRY_GROUP, NULL, count(*), {rate}, NULL, NULL, NULL FROM a GROUP BY ENQUIRY_GROUP
UNION ALL
SELECT 6, NAME_CONTRACT_TYPE,
       CASE FLAG_OWN_REALTY WHEN 'Y' THEN 'Propriétaire' WHEN 'N' THEN 'Non propriétaire' END,
       count(*), {rate}, NULL, round(avg(AMT_CREDIT), 0), NULL
FROM a GROUP BY NAME_CONTRACT_TYPE, FLAG_OWN_REALTY
UNION ALL
SELECT 7, NAME_FAMILY_STATUS, CAST(CNT_CHILDREN AS VARCHAR), count(*), {rate}, NULL, NULL, NULL
FROM a GROUP BY NAME_FAMILY_STATUS, CNT_CHILDREN HAVING count(*) > 50
UNION ALL
SELECT 8, WEEKDAY_APPR_PROCESS_START, NULL, count(*), {rate}, NULL, round(avg(AMT_CREDIT), 0),
       list_position(['MONDAY', 'TUESDAY', 'WEDNESDAY', 'THURSDAY', 'FRIDAY', 'SATURDAY', 'SUNDAY'],
                     WEEKDAY_APPR_PROCESS_START) - 1
FROM a GROUP BY WEEKDAY_APPR_PROCESS_START
"""

# Chart cells over the unusual view: no status or flag is listed here.
_CONTRACT_CELLS = """
SELECT NAME_CONTRACT_TYPE,
       coalesce(CASE FLAG_OWN_REALTY WHEN 'Y' THEN 'Propriétaire' WHEN 'N' THEN 'Non propriétaire'
                ELSE FLAG_OWN_REALTY END, '(null)') AS LABEL,
       round(avg(CASE WHEN TARGET = 1 THEN 1 ELSE 0 END) * 100, 2) AS VALUE
FROM applications GROUP BY NAME_CONTRACT_TYPE, FLAG_OWN_REALTY
"""

_FAMILY_CELLS = """
SELECT CNT_CHILDREN, coalesce(NAME_FAMILY_STATUS, '(null)') AS LABEL,
       round(avg(CASE WHEN TARGET = 1 THEN 1 ELSE 0 END) * 100, 2) AS VALUE
FROM applications GROUP BY CNT_CHILDREN, NAME_FAMILY_STATUS HAVING count(*) > 50
"""

_LOOKUP_BATCH = """
SELECT i.SK_ID_CURR, a.SK_ID_CURR IS NOT NULL AS found, a.AMT_CREDIT, a.NAME_CONTRACT_TYPE
FROM (SELECT c_custkey * 3 AS SK_ID_CURR FROM customer) i LEFT JOIN applications a USING (SK_ID_CURR)
"""

_FIT_CHECK = """
SELECT count(*) AS CLIENT_COUNT, round(avg(TARGET), 3) AS DEFAULT_SHARE, round(avg(TARGET), 3) AS MEAN_SCORE
FROM applications
"""

_FIXED_MODEL = """,
z AS (
  SELECT SK_ID_CURR, 0.625e0 - 1.25e0 * coalesce(EXT_SOURCE_1, avg(EXT_SOURCE_1) OVER ())
         - 2e0 * coalesce(EXT_SOURCE_2, avg(EXT_SOURCE_2) OVER ())
         + 0.75e0 * coalesce(EXT_SOURCE_3, avg(EXT_SOURCE_3) OVER ())
         + 0.03125e0 * coalesce(OWN_CAR_AGE, avg(OWN_CAR_AGE) OVER ())
         + coalesce(AMT_GOODS_PRICE, avg(AMT_GOODS_PRICE) OVER ()) / 1048576e0
         + CASE FLAG_OWN_CAR WHEN 'Y' THEN 0.5e0 ELSE 0e0 END AS z
  FROM applications
),
p AS (SELECT SK_ID_CURR, 1e0 / (1e0 + exp(-z)) AS p FROM z)
SELECT SK_ID_CURR, round(p, 6) AS risk_score, CASE WHEN p > 0.5e0 THEN 1e0 ELSE 0e0 END AS prediction,
       CASE WHEN p >= 0.70e0 THEN 'Élevé' WHEN p >= 0.40e0 THEN 'Moyen' ELSE 'Faible' END AS risk_level
FROM p
"""

_BASE_ANALYSES = """,
b AS (SELECT * FROM applications WHERE AMT_CREDIT >= 100000 AND AMT_CREDIT <= 300000)
SELECT 1 AS ANALYSIS, CASE WHEN -DAYS_BIRTH / 365.25e0 < 25 THEN '< 25 ans'
              WHEN -DAYS_BIRTH / 365.25e0 < 35 THEN '25-35 ans'
              WHEN -DAYS_BIRTH / 365.25e0 < 45 THEN '35-45 ans'
              WHEN -DAYS_BIRTH / 365.25e0 < 55 THEN '45-55 ans' ELSE '> 55 ans' END AS KEY,
       count(*) AS CLIENT_COUNT, {rate}
FROM b GROUP BY 2
UNION ALL
SELECT 3, NAME_INCOME_TYPE, count(*), {rate} FROM b GROUP BY NAME_INCOME_TYPE HAVING count(*) > 100
"""

_MALFORMED = """
SELECT event_id,
       CASE WHEN bad THEN NULL WHEN event_id % 19 = 0 OR event_id % 3 = 0 THEN 'Message vide'
            WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS message,
       CASE WHEN bad THEN NULL WHEN event_id % 19 = 0 THEN true
            ELSE event_id % 16 NOT IN (2, 4, 5, 6, 8, 9, 11) END AS is_positive,
       CASE WHEN bad THEN 'MALFORMED' WHEN event_id % 19 = 0 THEN 'INFO'
            WHEN event_id % 16 IN (2, 4, 5, 6, 8, 9, 11) THEN 'ERROR' ELSE 'INFO' END AS level,
       bad AS malformed, CASE WHEN bad THEN value END AS _corrupt_record
FROM (SELECT *, event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 AS bad FROM bodies)
"""


def _preprocess() -> str:
    """Mean imputation, and category indexes by falling frequency (ties by name)."""
    ranks = ",\n".join(
        f"r_{c} AS (SELECT {c} AS k, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i FROM p GROUP BY {c})"
        for c in CATEGORICAL_COLS)
    cols = [f"round(coalesce({c}, avg({c}) OVER ()), 4) AS {c}__imp" for c in NUMERIC_COLS]
    cols += [f"CAST(r_{c}.i AS INTEGER) AS {c}__idx" for c in CATEGORICAL_COLS]
    joins = "\n".join(f"JOIN r_{c} ON p.{c} = r_{c}.k" for c in CATEGORICAL_COLS)
    return (f",\np AS ({duckdb_prepared_select()}),\n{ranks}\n"
            f"SELECT p.SK_ID_CURR, {', '.join(cols)}\nFROM p\n{joins}")


def _apps(body: str, **kw) -> str:
    return _APPS + "\n" + body.format(rate=_RATE, **kw)


def oracle_sql() -> dict[str, str]:
    contract = _CONTRACT_GROUPS.format(rate=_RATE)
    family = _FAMILY_GROUPS.format(rate=_RATE)
    report = _REPORT_COLS
    return {
        "portfolio_filter": _apps(_FILTER),
        "age_band": _apps(_AGE),
        "credit_income_quintile": _apps(_QUINTILE, where=""),
        "credit_income_quintile_filtered": _apps(
            _QUINTILE, where="WHERE AMT_CREDIT >= 50000 AND AMT_INCOME_TOTAL >= 20000"),
        "credit_income_tiles": _apps(_TILES),
        "odd_amount_tiles": _apps(_ODD_TILES + "SELECT SK_ID_CURR, TILE FROM tiles", odd=duckdb_odd_amounts()),
        "odd_amount_sums": _apps(_ODD_TILES + "SELECT TILE, count(*) AS COUNT, count(AMT_CREDIT) AS CREDITS, "
                                 "CAST(sum(TARGET) AS BIGINT) AS DEFAULTS FROM tiles GROUP BY TILE",
                                 odd=duckdb_odd_amounts()),
        "income_type": _apps(_INCOME, where=""),
        "income_type_filtered": _apps(_INCOME, where="WHERE AMT_CREDIT >= 484000"),
        "employment_band": _apps(_EMPLOYMENT),
        "enquiry_band": _apps(_ENQUIRY),
        "contract_realty": _apps(_CONTRACT_GROUPS),
        "family_children": _apps(_FAMILY_GROUPS),
        "family_children_filtered": _apps(_FAMILY_GROUPS.replace(
            "FROM applications", "FROM applications WHERE AMT_CREDIT >= 460000")),
        "contract_realty_matrix_all": "WITH " + duckdb_unusual_cte() + _CONTRACT_CELLS,
        "family_children_matrix_all": "WITH " + duckdb_unusual_cte() + _FAMILY_CELLS,
        "base_analyses": _apps(_BASE_ANALYSES),
        "csv_applications": _APPS + "\nSELECT *, 0 AS _rejected FROM applications",
        "csv_applicants": _APPS + "\nSELECT * EXCLUDE (TARGET), 0 AS _rejected FROM applications",
        "preprocess_features": _APPS + _preprocess(),
        "client_lookup_batch": _apps(_LOOKUP_BATCH),
        "fit_check": _apps(_FIT_CHECK),
        "score_fixed_model": _APPS + _FIXED_MODEL,
        "score_response": _SCORED + f"\nSELECT {report} FROM scored",
        "format_unusual_clients": "WITH " + duckdb_scored_ctes(duckdb_unusual_cte())
            + _FORMAT.format(report=report),
        "weekday": _apps(_WEEKDAY),
        "cohort_report": _APPS + _REPORT.format(rate=_RATE),
        "age_band_records": _APPS + ",\nab AS (" + _AGE.format(rate=_RATE) + ")\n"
            "SELECT CAST(to_json(struct_pack(AGE_GROUP := AGE_GROUP, CLIENT_COUNT := CLIENT_COUNT, "
            "DEFAULT_RATE := DEFAULT_RATE)) AS VARCHAR) AS record FROM ab",
        "contract_realty_matrix": _APPS + _CONTRACT_MATRIX.format(groups=contract),
        "family_children_matrix": _APPS + _FAMILY_MATRIX.format(groups=family),
        "prepare_features": _APPS + "\n" + duckdb_prepared_select(),
        "client_lookup": _apps(_LOOKUP),
        "fallback_score": _SCORED + "\n" + _FALLBACK,
        "score_report": _SCORED + f"\nSELECT {report} FROM scored",
        "recommend": _SCORED + _RECOMMEND.format(level=_LEVEL),
        "format_client": _SCORED + _FORMAT.format(report=report),
        "stamp": _SCORED + "\n" + _STAMP,
        "client_response": _SCORED + _RESPONSE.format(
            report=report, fmt=_FORMAT_SELECT, level=_LEVEL.replace("risk_score", "f.risk_score")),
        "client_dossier": _SCORED + _DOSSIER.format(identities=duckdb_identities_cte(),
                                                     level=_LEVEL),
        "segment_filter": _SCORED + _SEGMENT.format(level=_LEVEL),
        "risk_level_summary": _SCORED + "\n" + _SUMMARY.format(level=_LEVEL),
        "feedback": "WITH " + duckdb_feedback_cte() + "\n" + _FEEDBACK,
        "feedback_json": "WITH " + duckdb_feedback_cte() + "\n" + _FEEDBACK_JSON,
        "feedback_malformed": "WITH " + duckdb_bodies_cte() + "\n" + _MALFORMED,
        "feedback_stream": "WITH " + duckdb_feedback_cte() + "\n" + _FEEDBACK_JSON,
    }
