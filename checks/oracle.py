"""The registered queries as SQL for DuckDB, written from the definitions of the results.

Shared steps are common table expressions; a query takes the ones it needs.
"""

from __future__ import annotations

import re

from checks.catalogue import RAW_SQL, TOP_N_BRANDS, TOP_N_COLORS

BLANK = r"[\s\p{Z}\x1c-\x1f\x{85}\v]"


def number(c: str, strip: str = "first") -> str:
    if strip == "first":
        text = rf"regexp_replace({c}, '^([\p{{Nd}}.]*)[^\p{{Nd}}.]', '\1')"
    else:
        text = rf"regexp_replace({c}, '[^\p{{Nd}}.]', '', 'g')"
    ok = rf"regexp_full_match({text}, '[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?')"
    return f"case when {ok} then try_cast({text} as double) end"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def plain_color(c: str) -> str:
    return f"coalesce(nullif(lower({strip(f'coalesce({c}, $$$$)')}), ''), 'unknown')"


def is_object(c: str) -> str:
    return f"(json_valid({c}) and json_type(case when json_valid({c}) then {c} end) = 'OBJECT')"


def kv_color(c: str) -> str:
    keys = ", ".join(
        f"lower({strip(f'json_extract_string(case when json_valid({c}) then {c} end, $$$.{k}$$)')})"
        for k in ("Colour", "Color", "colour", "color")
    )
    found = f"nullif(regexp_extract({c}, '''(?:Colour|Color|colour|color)'': ''([^'']+)''', 1), '')"
    return f"""case when {c} is null then null
      when {is_object(c)} then coalesce({keys}, 'unknown')
      when contains(lower({c}), 'color') then coalesce(lower({strip(found)}), 'unknown')
      else 'unknown' end"""


def category_keys(c: str) -> str:
    swapped = f"replace({c}, '''', '\"')"
    safe = f"case when json_valid({swapped}) then {swapped} end"
    return f"""case when {c} is null then null
      when {is_object(c)} then array_to_string(json_keys(case when json_valid({c}) then {c} end), ' ')
      when starts_with({c}, '{{') and json_valid({swapped}) then array_to_string(json_keys({safe}), ' ')
      else 'unknown' end"""


def first_url(c: str) -> str:
    head = f"split_part({c}, '|', 1)"
    return f"""case when {c} is null then null when starts_with({head}, 'http') then {strip(head)} else '' end"""


def flag(c: str) -> str:
    return f"case when upper({c}) = 'Y' then 1 else 0 end"


def tokens(c: str) -> str:
    return f"list_filter(regexp_split_to_array(lower(coalesce({c}, '')), '{BLANK}+'), lambda x: x <> '')"


def shown(c: str) -> str:
    return f"coalesce({c}, 'None')"


def unit(v: str) -> str:
    d = f"cast({v} as double[])"
    norm = f"sqrt(list_dot_product({d}, {d}))"
    return f"list_transform({d}, lambda x: x / case when {norm} = 0 then 1 else {norm} end)"


def audience(cat: str, name: str) -> str:
    text = f"lower({shown(cat)} || ' ' || {shown(name)})"
    return f"""case when regexp_matches({text}, 'women|woman|girls|girl|lady|ladies|female') then 'Women'
      when regexp_matches({text}, 'men |men''|mens| man |boys|boy|male') then 'Men' else 'Unisex' end"""


def short_text(p: str = "") -> str:
    return f"{shown(p + 'product_name')} || ' ' || {shown(p + 'brand')} || ' ' || {shown(p + 'categories')}"


def long_text(p: str = "") -> str:
    return (
        f"'Audience: ' || {audience(p + 'categories', p + 'product_name')} || ' | Category: ' || {shown(p + 'categories')}"
        f" || ' | Item: ' || {shown(p + 'product_name')} || ' | Color: ' || {shown(p + 'color')}"
        f" || ' | Brand: ' || {shown(p + 'brand')}"
    )


STEPS = {}
STEPS["raw"] = RAW_SQL.format(part="part", lineitem="lineitem")
STEPS["clean"] = f"""
select coalesce(uniq_id, '') as uniq_id, coalesce(product_name, '') as product_name, coalesce(brand, 'Unknown') as brand,
  {number('sales_price')} as sales_price,
  case when ({number('weight')}) < 999999999 then {number('weight')} end as weight,
  {number('rating')} as rating,
  {category_keys('parent___child_category__all')} as categories, {first_url('medium')} as image_url,
  coalesce(meta_keywords, '') as meta_keywords, coalesce(delivery_type, 'unknown') as delivery_type,
  {flag('amazon_prime__y_or_n')} as is_prime, {flag('best_seller_tag__y_or_n')} as is_bestseller,
  {plain_color('colour')} as color,
  coalesce({number('discount_percentage')}, 0.0) as discount_percentage,
  coalesce({number('no__of_reviews')}, 0.0) as no_of_reviews
from raw"""
NUMERIC = ("sales_price", "rating", "discount_percentage", "no_of_reviews")
STEPS["fit"] = "select " + ", ".join(
    f"median({c}) as med_{c}, min({c}) as min_{c}, max({c}) as max_{c}" for c in NUMERIC
) + " from clean"
for name, n in (("brand", TOP_N_BRANDS), ("color", TOP_N_COLORS)):
    STEPS[f"top_{name}"] = (
        f"select {name} as value, count(*) as n from clean group by {name} order by n desc, value limit {n}"
    )
STEPS["bucket"] = """
select uniq_id,
  case when brand in (select value from top_brand) then brand else 'Other' end as brand,
  case when color in (select value from top_color) then color else 'Other' end as color,
  delivery_type from clean"""
STEPS["vocab"] = """
select (select list(v order by v) from (select distinct brand as v from bucket)) as brands,
  (select list(v order by v) from (select distinct color as v from bucket)) as colors,
  (select list(v order by v) from (select distinct delivery_type as v from bucket)) as deliveries"""


def scaled(c: str) -> str:
    return f"(coalesce({c}, med_{c}) - min_{c}) / case when max_{c} = min_{c} then 1 else max_{c} - min_{c} end"


def one_hot(vocab: str, value: str) -> str:
    return f"list_transform({vocab}, lambda v: case when v = {value} then 1.0 else 0.0 end)"


STEPS["structured"] = f"""
select c.uniq_id, cast(list_concat([{', '.join(scaled('c.' + x).replace('med_c.', 'med_').replace('min_c.', 'min_').replace('max_c.', 'max_') for x in NUMERIC)}],
  {one_hot('brands', 'b.brand')}, {one_hot('colors', 'b.color')}, {one_hot('deliveries', 'b.delivery_type')},
  [cast(is_prime as double), cast(is_bestseller as double)]) as float[]) as structured
from clean c join bucket b on b.uniq_id = c.uniq_id cross join fit cross join vocab"""
STEPS["vectors"] = f"""
select cast(p_partkey as varchar) as uniq_id, cast({unit('embedding[1:32]')} as float[]) as text_vector,
  case when p_partkey % 25 = 0 then list_transform(range(32), lambda i: cast(0 as float))
       else cast({unit('embedding[33:64]')} as float[]) end as image_vector
from part join embeddings on vec_id = p_partkey % (select count(*) from embeddings)"""
STEPS["fused_two"] = f"""
select uniq_id, {unit('list_concat(cast(text_vector as double[]), ' + unit('structured') + ')')} as v
from vectors join structured using (uniq_id)"""
STEPS["fused_three"] = f"""
select uniq_id, {unit('list_concat(list_transform(v, lambda x: x * 0.4::double), list_transform(' + unit('image_vector') + ', lambda x: x * 0.6::double))')} as v
from fused_two join vectors using (uniq_id)"""
STEPS["dense_text_structured"] = "select uniq_id, cast(cast(v as float[]) as double[]) as v from fused_two"
STEPS["dense_combined"] = "select uniq_id, cast(cast(v as float[]) as double[]) as v from fused_three"
STEPS["dense_image"] = f"""
select uniq_id, cast(cast({unit('image_vector')} as float[]) as double[]) as v from vectors
where list_dot_product(cast(image_vector as double[]), cast(image_vector as double[])) > 1e-10"""
for mode in ("text_structured", "image", "combined"):
    STEPS[f"near_{mode}"] = f"""
select query_id, candidate_id, score, row_number() over (partition by query_id order by score desc, candidate_id) as rank
from (select q.uniq_id as query_id, i.uniq_id as candidate_id, round(list_dot_product(q.v, i.v), 6) as score
  from dense_{mode} q cross join dense_{mode} i)
qualify rank <= 100"""


def bm25(prefix: str, docs: str, queries: str, k: int) -> dict[str, str]:
    """Steps that score ``docs(doc_id, text)`` for ``queries(query_id, text)``; the last is <prefix>_ranked."""
    return {
        f"{prefix}_docs": f"select doc_id, {tokens('text')} as bag from ({docs})",
        f"{prefix}_len": f"select doc_id, len(bag) as dl from {prefix}_docs",
        f"{prefix}_corpus": f"select count(*) as n, sum(dl) / count(*) as avgdl from {prefix}_len",
        f"{prefix}_tf": f"""select doc_id, term, count(*) as tf from (select doc_id, unnest(bag) as term from {prefix}_docs)
          group by doc_id, term""",
        f"{prefix}_df": f"""select term, df, ln(n - df + 0.5) - ln(df + 0.5) as raw_idf
          from (select term, count(*) as df from {prefix}_tf group by term) cross join {prefix}_corpus""",
        f"{prefix}_idf": f"""select term, df, case when raw_idf < 0 then 0.25 * (select avg(raw_idf) from {prefix}_df)
          else raw_idf end as idf from {prefix}_df""",
        f"{prefix}_asked": f"select query_id, unnest({tokens('text')}) as term from ({queries})",
        f"{prefix}_ranked": f"""
        select query_id, candidate_id, score, row_number() over (partition by query_id order by score desc, candidate_id) as rank
        from (select query_id, t.doc_id as candidate_id,
            round(sum(idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) as score
          from (select query_id, term, count(*) as times from {prefix}_asked group by query_id, term) a
          join {prefix}_tf t using (term) join {prefix}_idf using (term) join {prefix}_len l on l.doc_id = t.doc_id
          cross join {prefix}_corpus cross join range(a.times) r(i)
          group by query_id, t.doc_id)
        where score <> 0 qualify rank <= {k}""",
    }


TEXTS = "select uniq_id as {id}, product_name || ' ' || brand || ' ' || coalesce(categories, '') as text from clean"
STEPS |= bm25("lex", TEXTS.format(id="doc_id"), TEXTS.format(id="query_id"), 100)
STEPS |= bm25(
    "doc", "select doc_id, text from documents", "select item_id as query_id, text from benchmark", 10
)
for mode in ("text_structured", "combined"):
    STEPS[f"rrf_{mode}"] = f"""
select query_id, candidate_id, score, dense_rank_, sparse_rank_,
  row_number() over (partition by query_id
    order by score desc, dense_rank_ nulls last, sparse_rank_ nulls last, candidate_id) as rank
from (select coalesce(d.query_id, s.query_id) as query_id, coalesce(d.candidate_id, s.candidate_id) as candidate_id,
    d.rank as dense_rank_, s.rank as sparse_rank_,
    coalesce(1e0 / (60 + d.rank), 0) + coalesce(1e0 / (60 + s.rank), 0) as score
  from near_{mode} d full outer join lex_ranked s on s.query_id = d.query_id and s.candidate_id = d.candidate_id)
qualify rank <= 100"""
STEPS["rrf_image"] = "select query_id, candidate_id, score, rank from near_image"
for mode in ("text_structured", "image", "combined"):
    STEPS[f"cand_{mode}"] = f"""
select query_id, candidate_id, score, row_number() over (partition by query_id order by rank) as rank
from rrf_{mode} where query_id <> candidate_id"""


def overlap(a: str, b: str) -> str:
    x, y = f"list_distinct({tokens(a)})", f"list_distinct({tokens(b)})"
    both = f"len(list_intersect({x}, {y}))"
    return f"cast({both} as double) / (len({x}) + len({y}) - {both})"


for mode in ("text_structured", "combined"):
    for kind, text in (("short", short_text), ("long", long_text)):
        STEPS[f"{kind}_{mode}"] = f"""
select query_id, candidate_id, score, stage1,
  row_number() over (partition by query_id order by score desc, stage1) as rank
from (select query_id, candidate_id, c.rank as stage1, {overlap(text('q.'), text('i.'))} as score
  from cand_{mode} c join clean q on q.uniq_id = query_id join clean i on i.uniq_id = candidate_id
  where c.rank <= 15)"""
for kind in ("short", "long"):
    STEPS[f"{kind}_image"] = "select query_id, candidate_id, score, rank from cand_image"

STEPS["modelled"] = f"""
select uniq_id, case when cast(uniq_id as bigint) % 7 = 0 then [0e0, 0e0, 0e0]
  else cast(cast({unit('[len(product_name), 2e0 * len(product_name), len(product_name) + 3e0]')} as float[]) as double[]) end as v
from clean"""
STEPS["modelled_images"] = f"""
select uniq_id, case when cast(uniq_id as bigint) % 5 = 0 then [0e0, 0e0, 0e0]
  else cast(cast({unit('[cast(strlen(product_name) as double), 3e0, cast(strlen(product_name) % 5 as double)]')} as float[]) as double[]) end as v
from clean"""
STEPS["purged_ones"] = """
select uniq_id from vectors where list_dot_product(cast(image_vector as double[]), cast(image_vector as double[])) <= 1e-10"""
STEPS["left_over"] = "select * from clean where uniq_id not in (select uniq_id from purged_ones)"
STEPS["near_all_centers"] = """
select vec_id, cast(embedding as double[]) as v, cell,
  list_dot_product(cast(embedding as double[]), c) - list_dot_product(c, c) / 2 as closeness
from embeddings cross join (select vec_id as cell, cast(embedding as double[]) as c from embeddings where vec_id < 16) x"""
STEPS["used_centers"] = """
select distinct cell from (select cell, row_number() over (partition by vec_id order by closeness desc, cell) as place
  from near_all_centers) y where place = 1"""
STEPS["near_centers"] = """
select vec_id, v, cell, row_number() over (partition by vec_id order by closeness desc, cell) as place
from near_all_centers join used_centers using (cell)"""
STEPS["requests"] = """
select event_id as request_id, cast(user_id * 7 as varchar) as product_id,
  case when event_type = 'error' and user_id % 5 = 0 then 0
       when event_type = 'signup' and user_id % 9 = 0 then 100000000
       else 1 + user_id % 12 end as num_similar,
  case event_type when 'view' then 'text_structured' when 'click' then 'image' when 'purchase' then 'combined'
    when 'signup' then 'image' else 'hybrid' end as mode
from events"""
STEPS["checked"] = """
select request_id, product_id, num_similar, mode,
  case when num_similar <= 0 then 422
       when product_id not in (select uniq_id from clean) then 404
       when mode not in ('text_structured', 'image', 'combined') then 422
       when mode = 'image' and product_id not in (select uniq_id from dense_image) then 404
       when num_similar > (case when mode = 'image' then (select count(*) - 1 from dense_image) else (select count(*) - 1 from clean) end)
         then 400 else 200 end as status,
  case when num_similar <= 0 then 'num_similar must be above 0'
       when product_id not in (select uniq_id from clean) then 'product not found'
       when mode not in ('text_structured', 'image', 'combined') then 'mode not available'
       when mode = 'image' and product_id not in (select uniq_id from dense_image) then 'product has no vector in this mode'
       when num_similar > (case when mode = 'image' then (select count(*) - 1 from dense_image) else (select count(*) - 1 from clean) end)
         then 'num_similar exceeds maximum (' || (case when mode = 'image' then (select count(*) - 1 from dense_image)
           else (select count(*) - 1 from clean) end) || ')' else 'ok' end as reason
from requests"""


def needed(text: str, found: list[str]) -> list[str]:
    """Steps named in ``text`` and, before them, the steps those are made from."""
    for name in re.findall(r"\b(?:from|join) (\w+)", text):
        if name in STEPS and name not in found:
            needed(STEPS[name], found)
            if name not in found:
                found.append(name)
    return found


def sql(text: str) -> str:
    steps = needed(text, [])
    if not steps:
        return text
    return "with " + ",\n".join(f"{n} as materialized ({STEPS[n]})" for n in steps) + "\n" + text


def elements(table: str, column: str) -> str:
    """One row per vector element, rounded; adding 0 turns a negative zero into zero."""
    return f"""select uniq_id, unnest(range(len({column}))) as pos,
      unnest(list_transform({column}, lambda x: round(cast(x as double), 6) + 0e0)) as value
      from {table}"""


def _queries() -> dict[str, str]:
    q = {}
    q["clean_catalogue"] = "select * from clean"
    q["clean_numeric"] = f"""select uniq_id, {number('sales_price')} as price_first, {number('sales_price', 'all')} as price_all,
      {number('weight')} as weight_raw, case when ({number('weight')}) < 999999999 then {number('weight')} end as weight,
      {number('rating')} as rating, {number('discount_percentage')} as discount, {number('no__of_reviews')} as reviews from raw"""
    q["clean_flags"] = f"""select uniq_id, {flag('amazon_prime__y_or_n')} as is_prime,
      {flag('best_seller_tag__y_or_n')} as is_bestseller from raw"""
    q["clean_color"] = f"""select uniq_id, {plain_color('colour')} as color,
      {kv_color('product_details__k_v_pairs')} as kv_color from raw"""
    q["clean_first_url"] = f"select uniq_id, {first_url('medium')} as image_url, coalesce(starts_with(medium, 'http'), false) as fetchable from raw"
    q["clean_category_keys"] = f"""select uniq_id as id, {category_keys('parent___child_category__all')} as keys from raw
      union all select 'event ' || event_id, {category_keys('props')} from events"""
    words3 = f"array_to_string((list_filter(regexp_split_to_array({shown('categories')}, '{BLANK}+'), lambda x: x <> ''))[1:3], ' ')"
    parts = ["product_name", "brand", "case when color = 'unknown' then '' else color end", words3, "left(meta_keywords, 150)"]
    q["embedding_text"] = f"""select uniq_id, array_to_string(list_filter([{', '.join(parts)}],
      lambda x: {strip('x')} <> ''), ' | ') as text from clean"""
    q["rerank_text"] = f"select uniq_id, {short_text()} as short_text, {long_text()} as long_text from clean"
    q["audience_class"] = f"""select {audience('categories', 'product_name')} as audience, count(*) as n from clean group by 1
      union all select {audience('lang', 'text')}, count(*) from documents group by 1"""
    q["tokenize_counts"] = f"""select doc_id, len(t) as n_tokens, len(list_distinct(t)) as n_distinct,
      coalesce(list_max(list_transform(t, lambda x: len(x))), 0) as longest from (select doc_id, {tokens('text')} as t from documents)"""
    q["numeric_fit"] = " union all ".join(
        f"select '{c}' as feature, round(med_{c}, 6) as median, round(min_{c}, 6) as minimum, round(max_{c}, 6) as maximum from fit"
        for c in NUMERIC
    )
    q["minmax_transform"] = "select uniq_id, " + ", ".join(
        f"round({scaled(c)}, 6) + 0e0 as {c}" for c in NUMERIC
    ) + " from clean cross join fit"
    q["topn_vocab"] = " union all ".join(
        f"select '{f}' as feature, unnest({v}) as value, unnest(range(len({v}))) as position from vocab"
        for f, v in (("brand", "brands"), ("color", "colors"), ("delivery_type", "deliveries"))
    )
    q["rare_bucket"] = "select uniq_id, brand, color from bucket"
    q["onehot_assemble"] = elements("structured", "structured")
    q["l2_normalize"] = f"""select vec_id as uniq_id, unnest(range(len(v))) as pos, unnest(list_transform(v, lambda x: round(x, 6) + 0e0)) as value
      from (select vec_id, {unit('list_transform(cast(embedding as double[]), lambda x: 3 * x)')} as v from embeddings)"""
    q["fuse_two"] = elements("fused_two", "v")
    q["fuse_three"] = elements("fused_three", "v")
    for mode in ("text_structured", "image", "combined"):
        name = {"text_structured": "text"}.get(mode, mode)
        q[f"knn_exact_{name}"] = f"select query_id, candidate_id, score, rank from near_{mode} where rank <= 10"
    q["knn_ivf_all_cells"] = q["knn_ivf_widened"] = q["knn_exact_text"]
    q["knn_pq_given_codebooks"] = """
        with base as (select vec_id, embedding::double[] as v from embeddings),
        subs as (select vec_id, j, v[j * 8 + 1 : j * 8 + 8] as x from base, range(8) t(j)),
        words as (select vec_id as c, j, x as w from subs where vec_id < 16),
        products as (select vec_id, j, c, list_inner_product(x, w) as t, list_inner_product(w, w) / 2 as half from subs join words using (j)),
        codes as (select vec_id, j, c from products qualify row_number() over (partition by vec_id, j order by t - half desc, c) = 1),
        near as (
            select q.vec_id as query_id, i.vec_id as candidate_id, round(sum(t), 6) as score
            from products q join codes i on i.j = q.j and i.c = q.c group by all
        ),
        short as (select query_id, candidate_id from near qualify row_number() over (partition by query_id order by score desc, candidate_id) <= 50),
        exact as (
            select query_id, candidate_id, round(list_inner_product(a.v, b.v), 6) as score
            from short join base a on a.vec_id = query_id join base b on b.vec_id = candidate_id
        )
        select *, cast(row_number() over (partition by query_id order by score desc, candidate_id) as integer) as rank from exact
        qualify rank <= 10
    """
    hop = """select b from {r} union select e.b from edges e join {r} r on e.a = r.b"""
    q["knn_graph_given_edges"] = f"""
        with base as (select vec_id, embedding::double[] as v from embeddings),
        edges as (select a, b from (select vec_id as a, unnest([3 * vec_id + 1, vec_id + 17, vec_id // 2]) as b from base) where b in (select vec_id from base)),
        r0 as (select vec_id as b from base where vec_id < 8),
        r1 as ({hop.format(r="r0")}), r2 as ({hop.format(r="r1")}), r3 as ({hop.format(r="r2")}),
        scored as (
            select q.vec_id as query_id, i.vec_id as candidate_id, round(list_inner_product(q.v, i.v), 6) as score
            from base i join r3 on r3.b = i.vec_id, base q where q.vec_id % 100 = 0
        )
        select *, cast(row_number() over (partition by query_id order by score desc, candidate_id) as integer) as rank from scored
        qualify rank <= 10
    """
    q["knn_embeddings"] = """
      select query_id, candidate_id, score, rank from (select *, row_number() over (partition by query_id order by score desc, candidate_id) as rank
      from (select q.vec_id as query_id, i.vec_id as candidate_id,
        round(list_dot_product(cast(q.embedding as double[]), cast(i.embedding as double[])), 6) as score
        from embeddings q cross join embeddings i)) where rank <= 5"""
    q["knn_embeddings_bounded"] = """
      select query_id, candidate_id, score, rank from (select *, row_number() over (partition by query_id order by score desc, candidate_id) as rank
      from (select q.vec_id as query_id, i.vec_id as candidate_id,
        round((1 + i.vec_id % 5) * list_dot_product(cast(q.embedding as double[]), cast(i.embedding as double[])), 6) as score
        from embeddings q cross join embeddings i where q.vec_id % 100 = 0)) where rank <= 10"""
    q["vector_distances"] = """
      select cast(vec_id as bigint) as vec_id, round(list_dot_product(cast(embedding as double[]), cast(c as double[])), 6) + 0e0 as dot,
        round(list_sum(list_transform(list_zip(embedding, c), lambda z: power(cast(z[1] as double) - cast(z[2] as double), 2))), 6) as squared_l2
      from embeddings cross join (select embedding as c from embeddings where vec_id = (select min(vec_id) from embeddings))"""
    q["corpus_stats"] = """select term, df, round(idf, 6) as idf from doc_idf"""
    q["corpus_totals"] = "select n as n_docs, round(avgdl, 6) as avgdl from doc_corpus"
    q["bm25_topk"] = "select query_id, candidate_id, score, rank from doc_ranked"
    q["bm25_catalogue"] = "select query_id, candidate_id, score, rank from lex_ranked"
    q["rrf_fusion"] = """select query_id, candidate_id, round(score, 9) as score, dense_rank_ as dense_rank,
      sparse_rank_ as sparse_rank, rank from rrf_text_structured"""
    q["candidates_by_mode"] = " union all ".join(
        f"select '{m}' as mode, query_id, candidate_id, round(score, 9) as score, rank from cand_{m}"
        for m in ("text_structured", "image", "combined")
    )
    q["recommend_ids"] = " union all ".join(
        f"select '{m}' as mode, query_id, rank, candidate_id from short_{m} where rank <= 10"
        for m in ("text_structured", "image", "combined")
    )
    fields = "product_name, brand, sales_price, rating, image_url"
    q["recommend_detailed"] = " union all ".join(
        f"""select '{m}' as mode, query_id, rank, candidate_id, round(score, 9) as score,
        '{'cosine' if m == 'image' else 'pair'}' as score_kind, {fields}
        from long_{m} join clean on uniq_id = candidate_id where rank <= 10"""
        for m in ("text_structured", "image", "combined")
    )
    dead = "list_dot_product(cast(image_vector as double[]), cast(image_vector as double[])) <= 1e-10"
    q["purge_missing_image"] = f"select c.* from clean c join vectors v on v.uniq_id = c.uniq_id where not ({dead})"
    q["purged_ids"] = f"select uniq_id, 'dead image link' as reason from vectors where {dead}"
    q["vector_counts"] = f"""select count(*) filter (not ({dead})) as valid, count(*) filter ({dead}) as dead from vectors"""
    q["request_status"] = "select request_id, product_id, num_similar, mode, status, reason from checked"
    q["request_answers"] = " union all ".join(
        f"""select request_id, a.rank, candidate_id from checked r join short_{m} a
        on a.query_id = r.product_id and a.rank <= r.num_similar where status = 200 and mode = '{m}'"""
        for m in ("text_structured", "image", "combined")
    )
    q["request_counts"] = q["request_counts_ivf"] = "select request_id, num_similar, cast(num_similar as bigint) as n_rows from checked where status = 200"
    q["request_details"] = " union all ".join(
        f"""select request_id, a.rank, candidate_id, {fields} from checked r join short_{m} a
        on a.query_id = r.product_id and a.rank <= r.num_similar join clean on uniq_id = candidate_id
        where status = 200 and mode = '{m}'"""
        for m in ("text_structured", "image", "combined")
    )
    q["product_lookup"] = f"""select product_id, case when uniq_id is null then 404 else 200 end as status,
      case when uniq_id is null then 'product not found' else 'ok' end as reason, {fields}
      from requests left join clean on uniq_id = product_id"""
    q["recommend_ivf_all_cells"] = q["recommend_ids"]
    q["knn_ivf_given_centers"] = """
      select query_id, candidate_id, score, rank from (
        select *, row_number() over (partition by query_id order by score desc, candidate_id) as rank from (
          select p.vec_id as query_id, i.vec_id as candidate_id, round(list_dot_product(p.v, i.v), 6) as score
          from near_centers p join near_centers i on i.cell = p.cell and i.place = 1 where p.place <= 4))
      where rank <= 10"""
    q["recommend_nested_rows"] = " union all ".join(
        f"""select '{m}' as mode, query_id, rank, candidate_id, round(score, 9) as score, product_name, brand
        from long_{m} join clean on uniq_id = candidate_id where rank <= 5"""
        for m in ("text_structured", "image", "combined")
    )
    q["encoder_roundtrip"] = q["onehot_assemble"]
    q["ndjson_catalogue"] = q["clean_catalogue"]
    q["model_vectors"] = elements("modelled", "v")
    q["image_model_vectors"] = elements("modelled_images", "v")
    q["clean_without_optional_columns"] = f"""select c.* replace (k.color as color, 0e0 as discount_percentage, 0e0 as no_of_reviews)
      from clean c join (select uniq_id, {kv_color('product_details__k_v_pairs')} as color from raw) k on k.uniq_id = c.uniq_id"""
    q["measurements_roundtrip"] = """select event_type, count(*) as n, round(avg(value), 6) as mean, max(value) as most from events group by 1"""
    largest = "(select count(*) - 1 from left_over)"
    tests = [
        ("num_similar <= 0", 422, "'num_similar must be above 0'"),
        ("product_id in (select uniq_id from purged_ones)", 404, "'product was purged: dead image link'"),
        ("product_id not in (select uniq_id from clean)", 404, "'product not found'"),
        ("mode not in ('text_structured', 'image', 'combined')", 422, "'mode not available'"),
        (f"num_similar > {largest}", 400, f"'num_similar exceeds maximum (' || {largest} || ')'"),
    ]
    q["purged_request_status"] = f"""select request_id, product_id, num_similar, mode,
      case {' '.join(f'when {t} then {code}' for t, code, _ in tests)} else 200 end as status,
      case {' '.join(f'when {t} then {why}' for t, _, why in tests)} else 'ok' end as reason from requests"""
    q["purged_product_lookup"] = f"""select product_id, case when l.uniq_id is null then 404 else 200 end as status,
      case when l.uniq_id is not null then 'ok' when p.uniq_id is not null then 'product was purged: dead image link'
        else 'product not found' end as reason, {fields}
      from requests left join left_over l on l.uniq_id = product_id left join purged_ones p on p.uniq_id = product_id"""
    q["availability"] = """select count(*) as products_indexed, 'text_structured,image,combined' as available_modes from clean"""
    q["product_card"] = "select uniq_id, product_name, brand, sales_price, rating, color, categories, image_url from clean"
    q["recall_at_k"] = """select e.query_id, count(a.candidate_id) / 10e0 as recall
      from near_combined e left join near_text_structured a
        on a.query_id = e.query_id and a.candidate_id = e.candidate_id and a.rank <= 10
      where e.rank <= 10 group by e.query_id"""
    q["cross_modal_jaccard"] = """
      select c.uniq_id as query_id, round(coalesce(j, 0), 9) as jaccard from clean c left join (
        select query_id, count(*) filter (lists = 2) / cast(count(*) as double) as j from (
          select query_id, candidate_id, count(*) as lists from (
            select query_id, candidate_id from short_text_structured where rank <= 10
            union all select query_id, candidate_id from short_image where rank <= 10)
          group by query_id, candidate_id) group by query_id) x on x.query_id = c.uniq_id"""
    q["percentile_summary"] = """select round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.95), 6) as p95,
      round(quantile_cont(value, 0.99), 6) as p99, round(avg(value), 6) as mean from events"""
    raw_columns = (
        "uniq_id product_name brand sales_price weight rating parent___child_category__all medium meta_keywords "
        "delivery_type amazon_prime__y_or_n best_seller_tag__y_or_n colour product_details__k_v_pairs "
        "discount_percentage no__of_reviews"
    ).split()
    q["profile_missing"] = "select * from (" + " union all ".join(
        f"select '{c}' as column_name, round(avg(case when {c} is null then 1e0 else 0e0 end) * 100, 6) as pct_missing from raw"
        for c in raw_columns
    ) + ") where pct_missing > 0"
    q["profile_top_values"] = "select brand as value, count(*) as n from raw where brand is not null group by 1 order by n desc, value limit 15"
    price = r"try_cast(nullif(regexp_extract(replace(replace({c}, '$', ''), ',', ''), '\d+\.?\d*'), '') as double)"
    q["profile_price"] = f"select uniq_id, {price.format(c='sales_price')} as price from raw"
    q["profile_histogram"] = """
      with v as (select l_extendedprice / l_quantity / 10 as v from lineitem where l_extendedprice / l_quantity / 10 < 500),
      r as (select min(v) as lo, max(v) as hi from v),
      b as (select least(cast(floor((v - lo) / ((hi - lo) / 50)) as int), 49) as bin, count(*) as n from v cross join r group by 1)
      select cast(g as int) as bin, round(lo + g * ((hi - lo) / 50), 6) as low, round(lo + (g + 1) * ((hi - lo) / 50), 6) as high,
        coalesce(n, 0) as n from range(50) t(g) cross join r left join b on b.bin = g"""
    q["seeded_sample"] = """select event_id, user_id, value from events order by md5('42:' || event_id), event_id limit 100"""
    q["first_middle_last"] = """select uniq_id, product_name from (select *, row_number() over (order by uniq_id) - 1 as i, count(*) over () as n from clean)
      where i in (0, n // 2, n - 1)"""
    q["artifact_roundtrip"] = """select uniq_id, brand, sales_price, round(list_sum(cast(structured as double[])), 4) as structured_sum,
      round(list_dot_product(cast(text_vector as double[]), cast(text_vector as double[])), 4) as text_norm
      from clean join structured using (uniq_id) join vectors using (uniq_id)"""
    return {name: sql(text) for name, text in q.items()}


QUERIES = _queries()
