"""Independent SQL (DuckDB dialect) for every registered query.

Written directly against the driver tables, without the wide layout: the
oracle derives each long table straight from orders / lineitem / part, so it
checks the unpivot, header parsing, aliasing, rules, dedupe and indicator
arithmetic of the Spark side rather than repeating them.  Percentages use
integer half-up arithmetic, which equals Spark's ``round`` on doubles.
"""

from __future__ import annotations

from . import virtual as V


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def pct(q: str, t: str) -> str:
    return f"(CAST((({q}) * 20000 + ({t})) // (2 * ({t})) AS DOUBLE) / 100.0)"


def _edition(wave: str = "wave") -> str:
    return (f"(CASE WHEN {wave} < {V.EDITION_START[V.E2]} THEN 'e1' "
            f"WHEN {wave} < {V.EDITION_START[V.E3]} THEN 'e2' ELSE 'e3' END)")


def _band_sql() -> str:
    labels = V.band_labels()
    parts = []
    for edge, label in zip(V.BAND_EDGES, labels):
        text = _q(label)
        for ed, (good, bad) in V.MISPRINTS.items():
            if good in label:
                text = f"(CASE WHEN {_edition()} = '{ed}' THEN {_q(label.replace(good, bad))} ELSE {text} END)"
        parts.append(f"WHEN o_totalprice <= {float(edge)} THEN {text}")
    return (f"(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN {_q(V.NO_BAND)} "
            f"ELSE (CASE {' '.join(parts)} ELSE {_q(labels[-1])} END) END)")



def _cte_defs(pay_dims=("segment", "region", "status"), pay_overall=True) -> dict[str, tuple[tuple[str, ...], str]]:
    """name -> (dependencies, body) for every relation the oracle uses."""
    types, items, colors = V.PART_TYPES, V.PART_ITEMS, V.PART_COLORS
    d: dict[str, tuple[tuple[str, ...], str]] = {}
    d["resp"] = ((), """
  SELECT o.o_orderkey, CASE WHEN o.o_orderkey % 97 IN (1, 2) THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END
         AS entity_id, CAST(year(o.o_orderdate) AS INTEGER) AS wave, o.o_orderstatus,
         o.o_totalprice, o.o_orderpriority, c.c_mktsegment, c.c_acctbal, n.n_name, r.r_name
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
  WHERE o.o_orderdate IS NOT NULL""")
    d["ent_raw"] = (("resp",), f"""
  SELECT entity_id, wave, CAST(o_orderkey AS BIGINT) AS response_id,
         CASE WHEN c_acctbal < 0 OR o_orderkey % 13 = 4 THEN NULL
              ELSE CAST(20 + floor((c_acctbal + 1000.0) / 250.0) AS INTEGER) END AS age,
         CASE WHEN o_orderkey % 11 IN (3, 5, 7) THEN NULL WHEN o_orderkey % 11 = 9 THEN c_mktsegment || ' "new"'
              ELSE c_mktsegment END AS segment, n_name AS nation, r_name AS region, {PRIORITY} AS priority,
         o_orderstatus AS status, CASE WHEN o_orderkey % 17 <> 6 THEN {_band_sql()} END AS pay_band
  FROM resp""")
    d["ent"] = (("ent_raw",), f"""
  SELECT {ENT_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY wave, entity_id ORDER BY response_id) AS rn FROM ent_raw)
  WHERE rn = 1""")
    d["lines"] = ((), rf"""
  SELECT l.l_orderkey,
         CASE WHEN p.p_type IN {_in(types)} THEN p.p_type ELSE 'OTHER' END AS f_type,
         CASE WHEN split_part(p.p_name, ' ', 2) IN {_in(items)} THEN split_part(p.p_name, ' ', 2)
              ELSE '{V.OTHER}' END AS f_item,
         CASE WHEN split_part(p.p_name, ' ', 1) IN {_in(colors)} THEN split_part(p.p_name, ' ', 1)
              ELSE '{V.OTHER}' END AS f_color,
         CASE WHEN l.l_returnflag IN {_in(V.RETURN_LABELS)} THEN l.l_returnflag ELSE '?' END AS f_return,
         CASE WHEN TRY_CAST(regexp_extract(p.p_brand, '#(\d+)$', 1) AS INTEGER) BETWEEN 1 AND {V.N_BRANDS}
              THEN TRY_CAST(regexp_extract(p.p_brand, '#(\d+)$', 1) AS INTEGER) ELSE {V.N_BRANDS + 1} END AS f_brand,
         l.l_linestatus AS f_status,
         CASE WHEN l.l_discount <= 0.0 THEN 1 WHEN l.l_discount < 0.035 THEN 2
              WHEN l.l_discount < 0.075 THEN 3 ELSE 4 END AS f_discount
  FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey""")
    d["lo"] = (("resp", "lines"), """
  SELECT r.entity_id, r.wave, r.o_orderkey, ln.* EXCLUDE (l_orderkey)
  FROM resp r JOIN lines ln ON ln.l_orderkey = r.o_orderkey""")

    cats = {"part_type": "f_type", "part_item": "f_item", "part_color": "f_color", "returns": "f_return"}
    selects = []
    for cat, col in cats.items():
        if cat == "part_type":
            title = f"(upper(substr({col}, 1, 1)) || lower(substr({col}, 2)))"
            original = f"(CASE WHEN {_edition()} = 'e1' THEN {col} ELSE {title} END)"
            item = title
        elif cat == "returns":
            original = _case(col, {**V.RETURN_LABELS, "?": "Other return status"})
            item = original
        else:
            original = item = col
        question = _per_edition({e: V.QUESTIONS[e][cat] for e in (V.E1, V.E2, V.E3)})
        comp = _per_edition({e: "semantic_attention" if (e, cat) in V.SEMANTIC_ATTENTION else "comparable"
                             for e in (V.E1, V.E2, V.E3)})
        selects.append(f"""
  SELECT entity_id, wave, '{cat}' AS category,
         {item} AS item, {original} AS item_original, {_class_sql(original)} AS item_type,
         {question} AS question, {comp} AS comparability, o_orderkey
  FROM lo WHERE {HAS_ID}""")
        if cat == "part_type":  # the option that stands twice in the form
            selects.append(f"""
  SELECT entity_id, wave, '{cat}', {item}, CASE WHEN {_edition()} = 'e1' THEN {title} ELSE {col} END, 'item',
         {question}, {comp}, o_orderkey
  FROM lo WHERE {HAS_ID} AND f_type = '{V.TWICE}' AND o_orderkey % 3 = 0""")
    d["sel_lines"] = (("lo",), "\n  UNION ALL".join(selects))
    d["sel_raw"] = (("sel_lines",), f"SELECT {SEL_COLS} FROM (SELECT DISTINCT * FROM sel_lines)")
    d["sel"] = (("sel_raw",), f"""
  SELECT {SEL_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY wave, entity_id, category, item
                                 ORDER BY item_original, question, item_type, comparability) AS rn
    FROM sel_raw) WHERE rn = 1""")

    status_text = _case("o_orderstatus", V.STATUS_TEXT)
    brand_code = "(CASE " + " ".join(f"WHEN f_brand = {n} THEN {_q(c)}" for n, c in V.BRAND_CODES.items()) + " END)"
    brand_label = "(CASE " + " ".join(f"WHEN f_brand = {n} THEN {_q(c)}" for n, c in V.BRAND_LABELS.items()) + " END)"
    disc_code = "(CASE " + " ".join(f"WHEN f_discount = {n} THEN {_q(c)}" for n, c in V.DISCOUNT_LEVELS.items()) + " END)"
    disc_label = "(CASE " + " ".join(f"WHEN f_discount = {n} THEN {_q(c)}" for n, c in V.DISCOUNT_LABELS.items()) + " END)"
    block_f = _per_edition({e: V._coded_prefixes(e)["brand_bought"][0] for e in (V.E1, V.E2, V.E3)})
    block_o = _per_edition({e: V._coded_prefixes(e)["brand_bought"][1] for e in (V.E1, V.E2, V.E3)})
    block_d = _per_edition({e: V._coded_prefixes(e)["discount_level"][0] for e in (V.E1, V.E2, V.E3)})
    d["ans_lines"] = (("resp", "lo"), f"""
  SELECT entity_id, wave, 'order_priority' AS dimension,
         {_rules_sql('o_orderpriority', V.PRIORITY_RULES)} AS answer, trim(o_orderpriority) AS answer_original,
         'single_choice' AS answer_type, 'comparable_all_editions' AS comparability, 'P3_e / 3.e' AS block,
         o_orderkey
  FROM resp WHERE {HAS_ID} AND {PRIORITY} IS NOT NULL
  UNION ALL
  SELECT entity_id, wave, 'order_status', {_rules_sql(status_text, V.STATUS_RULES)},
         trim({status_text}), 'single_choice', 'last_edition_only', '3.g', o_orderkey
  FROM resp WHERE {HAS_ID} AND {_edition()} = 'e3' AND {status_text} IS NOT NULL AND trim({status_text}) <> ''
  UNION ALL
  SELECT entity_id, wave, 'brand_bought', {brand_code}, {brand_label}, 'multi_select',
         'comparable_all_editions',
         CASE WHEN f_status = 'F' THEN {block_f} WHEN f_status <> 'F' THEN {block_o} END, o_orderkey
  FROM lo WHERE {HAS_ID}
  UNION ALL
  SELECT entity_id, wave, 'discount_level', {disc_code}, {disc_label}, 'multi_select',
         'comparable_all_editions', {block_d}, o_orderkey
  FROM lo WHERE {HAS_ID}""")
    d["ans_raw"] = (("ans_lines",), f"SELECT {ANS_COLS} FROM (SELECT DISTINCT * FROM ans_lines WHERE block IS NOT NULL)")
    d["ans"] = (("ans_raw",), f"""
  SELECT {ANS_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY wave, entity_id, dimension, answer
                                 ORDER BY block, answer_original, answer_type, comparability) AS rn
    FROM ans_raw) WHERE rn = 1""")

    dims = ["segment", "region", "nation", "status"]
    d["plong"] = (("ent",), " UNION ALL ".join(
        f"SELECT wave, entity_id, '{x}' AS dimension, {x} AS category FROM ent" for x in dims))
    d["pvalid"] = (("plong",), "SELECT * FROM plong WHERE category IS NOT NULL AND trim(category) <> ''")
    d["pcnt"] = (("pvalid",), "SELECT wave, dimension, category, count(DISTINCT entity_id) AS cnt FROM pvalid GROUP BY ALL")
    d["ptot"] = (("pvalid",), "SELECT wave, dimension, count(DISTINCT entity_id) AS tot FROM pvalid GROUP BY ALL")
    d["profile"] = (("pcnt", "ptot"), f"""
  SELECT c.wave, c.dimension, c.category, c.cnt AS "count", t.tot AS total_valid, {pct('c.cnt', 't.tot')} AS percent,
         CAST(row_number() OVER (PARTITION BY c.wave, c.dimension ORDER BY c.cnt DESC, c.category) AS INTEGER) AS "rank"
  FROM pcnt c JOIN ptot t ON c.wave = t.wave AND c.dimension = t.dimension""")

    spec = V.BAND_SPEC
    parts = []
    if pay_overall:
        parts.append("SELECT wave, entity_id, pay_band, 'overall' AS analysis_dimension, 'all' AS analysis_category FROM ent")
    parts += [f"SELECT wave, entity_id, pay_band, '{x}' AS analysis_dimension, {x} AS analysis_category FROM ent"
              for x in pay_dims]
    d["blong"] = (("ent",), " UNION ALL ".join(parts))
    d["bvalid"] = (("blong",), """SELECT * FROM blong WHERE pay_band IS NOT NULL AND trim(pay_band) <> ''
           AND analysis_category IS NOT NULL AND trim(analysis_category) <> ''""")
    d["bcnt"] = (("bvalid",), """SELECT wave, analysis_dimension, analysis_category, pay_band,
           count(DISTINCT entity_id) AS cnt FROM bvalid GROUP BY ALL""")
    d["btot"] = (("bvalid",), """SELECT wave, analysis_dimension, analysis_category,
           count(DISTINCT entity_id) AS tot FROM bvalid GROUP BY ALL""")
    d["pay"] = (("bcnt", "btot"), f"""
  SELECT c.wave, c.analysis_dimension, c.analysis_category, c.pay_band,
         CAST({_band_order_sql('c.pay_band')} AS INTEGER) AS band_order,
         {_anomaly_sql('c.pay_band')} AS band_anomaly,
         c.cnt AS "count", t.tot AS total_valid, {pct('c.cnt', 't.tot')} AS percent
  FROM bcnt c JOIN btot t ON c.wave = t.wave AND c.analysis_dimension = t.analysis_dimension
   AND c.analysis_category = t.analysis_category""")

    d["tbase"] = (("sel",), "SELECT wave, category, count(DISTINCT entity_id) AS tot FROM sel GROUP BY ALL")
    d["tcnt"] = (("sel",), """SELECT wave, category, item, comparability, count(DISTINCT entity_id) AS cnt
           FROM sel WHERE item_type = 'item' GROUP BY ALL""")
    d["tech"] = (("tcnt", "tbase"), f"""
  SELECT c.wave, c.category, c.item, c.cnt AS adopters, t.tot AS category_base,
         {pct('c.cnt', 't.tot')} AS adoption_percent,
         CAST(row_number() OVER (PARTITION BY c.wave, c.category ORDER BY c.cnt DESC, c.item) AS INTEGER) AS "rank",
         c.comparability
  FROM tcnt c JOIN tbase t ON c.wave = t.wave AND c.category = t.category""")

    d["abase"] = (("ans",), "SELECT wave, dimension, count(DISTINCT entity_id) AS tot FROM ans GROUP BY ALL")
    d["acnt"] = (("ans",), """SELECT wave, dimension, answer, answer_type, comparability,
           count(DISTINCT entity_id) AS cnt FROM ans GROUP BY ALL""")
    d["gans"] = (("acnt", "abase"), f"""
  SELECT c.wave, c.dimension, c.answer, c.cnt AS respondents, t.tot AS dimension_base,
         {pct('c.cnt', 't.tot')} AS percent,
         CAST(row_number() OVER (PARTITION BY c.wave, c.dimension ORDER BY c.cnt DESC, c.answer) AS INTEGER) AS "rank",
         c.answer_type, (c.answer_type = 'single_choice') AS percents_sum_to_100, c.comparability
  FROM acnt c JOIN abase t ON c.wave = t.wave AND c.dimension = t.dimension""")
    return d


def _band_order_sql(col: str) -> str:
    spec = V.BAND_SPEC
    whens = " ".join(f"WHEN starts_with({col}, {_q(p)}) THEN {k}" for p, k in spec.order_overrides.items())
    return (f"(CASE {whens} ELSE TRY_CAST(replace(regexp_extract({col}, 'R\\$\\s*([0-9\\.]+)', 1), '.', '') "
            "AS INTEGER) END)")


def _anomaly_sql(col: str) -> str:
    spec = V.BAND_SPEC
    return "(" + " OR ".join([f"starts_with({col}, {_q(p)})" for p in spec.anomaly_prefixes] +
                             [f"contains({col}, {_q(c)})" for c in spec.anomaly_contains]) + ")"


def _case(expr: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {_q(str(k))} THEN {_q(str(v))}" for k, v in mapping.items())
    return f"(CASE {expr} {whens} ELSE {default} END)"


def _class_sql(label: str) -> str:
    whens = " ".join(f"WHEN contains(lower({label}), {_q(p.lower())}) THEN {_q(c)}" for p, c in V.CLASS_RULES)
    return f"(CASE {whens} ELSE 'item' END)"


def _per_edition(values: dict) -> str:
    return "(CASE " + " ".join(f"WHEN {_edition()} = '{e}' THEN {_q(v)}" for e, v in values.items()) + " END)"


def _rules_sql(text: str, rules) -> str:
    whens = " ".join(f"WHEN contains(lower(trim({text})), {_q(p.lower())}) THEN {_q(c)}" for p, c in rules)
    return f"(CASE {whens} ELSE trim({text}) END)"


# answers that were spoiled in the form, and rows with an id
PRIORITY = "CASE WHEN o_orderkey % 19 NOT IN (7, 8) THEN o_orderpriority END"
HAS_ID = "entity_id IS NOT NULL"

ENT_COLS = "entity_id, wave, response_id, age, segment, nation, region, priority, status, pay_band"
SEL_COLS = "entity_id, wave, category, item, item_original, item_type, question, comparability"
ANS_COLS = "entity_id, wave, dimension, answer, answer_original, answer_type, comparability, block"


def sql(targets, body: str, extra: dict[str, tuple[tuple[str, ...], str]] | None = None, **kw) -> str:
    """``WITH`` list holding ``targets`` and everything they depend on, then ``body``."""
    defs = {**_cte_defs(**kw), **(extra or {})}
    order: list[str] = []

    def visit(name):
        if name in order:
            return
        for dep in defs[name][0]:
            visit(dep)
        order.append(name)
    for t in targets:
        visit(t)
    return "WITH " + ",\n".join(f"{n} AS ({defs[n][1]}\n)" for n in order) + "\n" + body


def oracle_sql() -> dict[str, str]:
    prof_cols = 'wave, dimension, category, "count", total_valid, percent, "rank"'
    pay_cols = ('wave, analysis_dimension, analysis_category, pay_band, band_order, band_anomaly, "count", '
                'total_valid, percent')
    tech_cols = 'wave, category, item, adopters, category_base, adoption_percent, "rank", comparability'
    gans_cols = ('wave, dimension, answer, respondents, dimension_base, percent, "rank", answer_type, '
                 'percents_sum_to_100, comparability')
    type_labels = {t: t[:1] + t[1:].lower() for t in V.PART_TYPES + ["OTHER"]}
    labels = {"labels": (("lo",), f"""
  SELECT wave, CASE WHEN {_edition()} = 'e1' THEN f_type ELSE {_case('f_type', type_labels)} END AS label
  FROM (SELECT DISTINCT o_orderkey, wave, f_type FROM lo)
  UNION ALL SELECT wave, CASE WHEN {_edition()} = 'e1' THEN {_q(V.TWICE[:1] + V.TWICE[1:].lower())} ELSE {_q(V.TWICE)} END
  FROM (SELECT DISTINCT o_orderkey, wave FROM lo WHERE f_type = '{V.TWICE}' AND o_orderkey % 3 = 0)
  UNION ALL SELECT wave, f_item FROM (SELECT DISTINCT o_orderkey, wave, f_item FROM lo)
  UNION ALL SELECT wave, f_color FROM (SELECT DISTINCT o_orderkey, wave, f_color FROM lo)
  UNION ALL SELECT wave, {_case('f_return', {**V.RETURN_LABELS, '?': 'Other return status'})}
  FROM (SELECT DISTINCT o_orderkey, wave, f_return FROM lo)""")}
    share_window = {
        "sw_base": (("ent",), "SELECT wave, segment AS category, count(*) AS quantity FROM ent "
                              "WHERE segment IS NOT NULL GROUP BY ALL"),
        "sw_sum": (("sw_base",), "SELECT wave, CAST(sum(quantity) AS BIGINT) AS s FROM sw_base GROUP BY ALL")}
    share_join = {
        "sj_b": (("ans",), "SELECT wave, answer, count(DISTINCT entity_id) AS quantity FROM ans "
                           "WHERE dimension = 'order_priority' GROUP BY ALL"),
        "sj_t": (("ans",), "SELECT wave, count(DISTINCT entity_id) AS total FROM ans "
                           "WHERE dimension = 'order_priority' GROUP BY ALL")}
    single = {
        "ss_b": (("ans",), "SELECT answer, count(DISTINCT entity_id) AS quantity FROM ans "
                           "WHERE wave = 2001 AND dimension = 'order_status' GROUP BY ALL"),
        "ss_s": (("ss_b",), "SELECT CAST(sum(quantity) AS BIGINT) AS s FROM ss_b")}
    return {
        "csv_roundtrip_scan": sql(["ent"], f"SELECT {ENT_COLS} FROM ent"),
        "harmonize_waves": sql(["ent_raw"], f"SELECT {ENT_COLS} FROM ent_raw"),
        "clean_text_nulls": sql(["ent_raw"], "SELECT wave, segment, count(*) AS responses, count(age) AS with_age "
                                             "FROM ent_raw GROUP BY ALL"),
        "tolerant_cast": sql(["ent_raw"], "SELECT wave, age, count(*) AS responses FROM ent_raw GROUP BY ALL"),
        "dedupe_entities": sql(["ent"], f"SELECT {ENT_COLS} FROM ent"),
        "dedupe_selections": sql(["sel"], f"SELECT {SEL_COLS} FROM sel"),
        "dedupe_answers": sql(["ans"], f"SELECT {ANS_COLS} FROM ans"),
        "multiselect_long": sql(["sel_raw"], f"SELECT {SEL_COLS} FROM sel_raw"),
        "multiselect_coded": sql(["ans_raw"], f"SELECT {ANS_COLS} FROM ans_raw WHERE answer_type = 'multi_select'"),
        "multiselect_two_blocks": sql(["ans"], f"SELECT {ANS_COLS} FROM ans WHERE dimension = 'brand_bought'"),
        "header_label_extract": sql(["labels"], "SELECT wave, label, count(*) AS selections FROM labels GROUP BY ALL",
                                    extra=labels),
        "alias_normalize": sql(["sel"], "SELECT wave, item_original, item, count(*) AS selections FROM sel "
                                        "WHERE category = 'part_type' GROUP BY ALL"),
        "item_classify": sql(["sel"], "SELECT category, item_original, item_type, count(*) AS selections "
                                      "FROM sel GROUP BY ALL"),
        "normalize_answers": sql(["ans"], "SELECT wave, answer_original, answer, count(*) AS respondents FROM ans "
                                          "WHERE dimension = 'order_priority' GROUP BY ALL"),
        "normalize_answers_priority_order": sql(["ans"], "SELECT wave, answer_original, answer, count(*) AS "
                                                         "respondents FROM ans WHERE dimension = 'order_status' "
                                                         "GROUP BY ALL"),
        "categorical_answers": sql(["ans_raw"], f"SELECT {ANS_COLS} FROM ans_raw WHERE answer_type = 'single_choice'"),
        "long_answers_union": sql(["ans_raw"], f"SELECT {ANS_COLS} FROM ans_raw"),
        "union_missing_columns": sql(["sel", "ans"], 'SELECT wave, category, dimension, count(*) AS "rows" FROM '
                                                     "(SELECT wave, category, NULL AS dimension FROM sel UNION ALL "
                                                     "SELECT wave, NULL, dimension FROM ans) GROUP BY ALL"),
        "band_order_parse": sql(["ent_raw"], f"SELECT DISTINCT pay_band, CAST({_band_order_sql('pay_band')} AS INTEGER)"
                                             " AS band_order FROM ent_raw WHERE pay_band IS NOT NULL"),
        "band_anomaly_flag": sql(["ent_raw"], f"SELECT wave, pay_band, {_anomaly_sql('pay_band')} AS band_anomaly, "
                                              "count(*) AS responses FROM ent_raw WHERE pay_band IS NOT NULL GROUP BY ALL"),
        "profile_distribution": sql(["profile"], f"SELECT {prof_cols} FROM profile"),
        "band_distribution_overall": sql(["pay"], f"SELECT {pay_cols} FROM pay", pay_dims=()),
        "band_distribution_by_dimension": sql(["pay"], f"SELECT {pay_cols} FROM pay", pay_dims=("segment",),
                                              pay_overall=False),
        "band_distribution_all": sql(["pay"], f"SELECT {pay_cols} FROM pay"),
        "adoption_share": sql(["tech"], f"SELECT {tech_cols} FROM tech"),
        "answer_share": sql(["gans"], f"SELECT {gans_cols} FROM gans"),
        "topk_per_group": sql(["tech"], f'SELECT {tech_cols}, "rank" AS top_rank FROM tech WHERE "rank" <= 5'),
        "count_by_wave": sql(["ent"], "SELECT wave, count(*) AS entities FROM ent GROUP BY ALL"),
        "sql_share_window": sql(["sw_base", "sw_sum"], f"SELECT b.wave, b.category, b.quantity, "
                                f"{pct('b.quantity', 's.s')} AS percent FROM sw_base b JOIN sw_sum s ON b.wave = s.wave",
                                extra=share_window),
        "count_by_wave_category": sql(["sel"], "SELECT wave, category, count(*) AS selections FROM sel GROUP BY ALL"),
        "sql_adoption_ranking": sql(["sel"], "SELECT wave, category, item, count(DISTINCT entity_id) AS adopters "
                                             "FROM sel WHERE item_type = 'item' GROUP BY ALL"),
        "count_by_wave_dimension": sql(["ans"], "SELECT wave, dimension, count(*) AS answers FROM ans GROUP BY ALL"),
        "sql_share_join": sql(["sj_b", "sj_t"], f"SELECT b.wave, b.answer, b.quantity, t.total AS total_respondents, "
                              f"{pct('b.quantity', 't.total')} AS percent FROM sj_b b JOIN sj_t t ON b.wave = t.wave",
                              extra=share_join),
        "sql_single_wave_share": sql(["ss_b", "ss_s"], f"SELECT b.answer, b.quantity, {pct('b.quantity', 's.s')} "
                                     "AS percent FROM ss_b b, ss_s s", extra=single),
        "sql_profile_rows_by_wave": sql(["profile"], "SELECT wave, count(*) AS row_count FROM profile GROUP BY ALL"),
        "sql_catalog_union_counts": sql(["profile", "pay", "tech", "gans"], """
SELECT 'profile' AS table_name, count(*) AS row_count FROM profile
UNION ALL SELECT 'pay', count(*) FROM pay
UNION ALL SELECT 'technologies', count(*) FROM tech
UNION ALL SELECT 'answers', count(*) FROM gans"""),
        "sql_profile_report": sql(["profile"], 'SELECT wave, category AS segment, "count", total_valid, percent, '
                                               "\"rank\" FROM profile WHERE dimension = 'segment'"),
        "sql_profile_report_status": sql(["profile"], 'SELECT wave, category AS status, "count", total_valid, percent '
                                                      "FROM profile WHERE dimension = 'status'"),
        "sql_profile_report_region": sql(["profile"], 'SELECT wave, category AS region, "count", percent '
                                                      "FROM profile WHERE dimension = 'region'"),
        "sql_profile_report_nation": sql(["profile"], 'SELECT wave, category AS nation, "count", percent '
                                                      "FROM profile WHERE dimension = 'nation'"),
        "sql_band_by_dimension": sql(["pay"], 'SELECT wave, analysis_category AS segment, pay_band, "count", percent, '
                                              "band_order FROM pay WHERE analysis_dimension = 'segment' "
                                              "AND band_anomaly = false"),
        "sql_top_technologies": sql(["tech"], 'SELECT wave, category, "rank", item, adopters, adoption_percent, '
                                              'comparability FROM tech WHERE "rank" <= 5'),
        "sql_indicator_subset": sql(["gans"], 'SELECT wave, dimension, answer, respondents, percent, "rank", '
                                              "percents_sum_to_100 FROM gans WHERE dimension IN "
                                              "('order_priority', 'order_status')"),
        "quality_row_counts": sql(["ent", "sel", "ans"], """
SELECT 'entities' AS table_name, wave, count(*) AS row_count FROM ent GROUP BY ALL
UNION ALL SELECT 'selections', wave, count(*) FROM sel GROUP BY ALL
UNION ALL SELECT 'answers', wave, count(*) FROM ans GROUP BY ALL"""),
        "quality_answer_distribution": sql(["ans"], "SELECT wave, dimension, answer, count(*) AS row_count FROM ans "
                                                    "GROUP BY ALL"),
        "dedupe_is_idempotent": sql(["sel"], f"SELECT {SEL_COLS} FROM sel WHERE false"),
        "quality_sample": sql(["sel"], f"SELECT {SEL_COLS} FROM sel ORDER BY wave, entity_id, category, item LIMIT 20"),
        "parquet_partition_roundtrip": sql(["ent"], "SELECT wave, segment, count(*) AS entities, "
                                                    "count(DISTINCT entity_id) AS distinct_ids, "
                                                    "CAST(sum(response_id) AS BIGINT) AS response_id_sum "
                                                    "FROM ent GROUP BY ALL"),
        "report_export_roundtrip": sql(["profile"], 'SELECT CAST(wave AS VARCHAR) AS wave, category AS segment, '
                                                    'CAST("count" AS VARCHAR) AS "count", '
                                                    'CAST(total_valid AS VARCHAR) AS total_valid, '
                                                    'CAST(percent AS VARCHAR) AS percent, '
                                                    'CAST("rank" AS VARCHAR) AS "rank" '
                                                    "FROM profile WHERE dimension = 'segment'"),
    }
