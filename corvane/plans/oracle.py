"""DuckDB SQL for the queries of the catalogue, on the driver's tables."""

from __future__ import annotations

from corvane.functions.config import GROUPS

BOXES = """boxes as (
  select event_id, image_id, grp, event_type, greatest(0, cx - hw) as x1, greatest(0, cy - hh) as y1, least(1000, cx + hw) as x2, least(1000, cy + hh) as y2,
    cast((event_id*7919) % 10007 as double) / cast(10007 as double) as score
  from (select event_id, user_id as image_id, concat('g0', cast(1 + user_id % 5 as varchar)) as grp, event_type,
      100 + 200*((event_id*31) % 5) + 10*((event_id*17) % 3 - 1) as cx, 100 + 200*(((event_id*13) // 5) % 5) + 10*((event_id*11) % 3 - 1) as cy,
      80 + 5*((event_id*7) % 5) as hw, 80 + 5*((event_id*3) % 5) as hh from events)),
truth as (select * from boxes where event_type = 'purchase' and grp <> 'g03'),
dets as (select * from boxes where event_type <> 'purchase')"""

SOURCES = """sources as (
  select d.doc_id, concat('0', cast(1 + cast(substring(d.source,4,10) as int) % 5 as varchar)) as grp, concat(d.source,'/',d.lang,'_',cast(d.doc_id as varchar),'.jpg') as original_file_name,
    sha1(d.text) as content_hash, cast(coalesce(l.quality + l.toxic, 0) as int) as n_ann, substring(sha1(concat_ws('|', d.source, cast(d.doc_id as varchar))),1,16) as source_key
  from documents d left join labels l on d.doc_id = l.doc_id)"""

SIGNATURES = """signatures as (
  select doc_id, cast(sum(case when v > 0 then 1::bigint << k else 0 end) as bigint) as sig from (
    select doc_id, k, sum(case when (h >> k) & 1 = 1 then 1 else -1 end) as v from
      (select distinct doc_id, ('0x' || substring(md5(w),1,8))::bigint as h from (select doc_id, unnest(string_split(lower(text),' ')) as w from documents))
      cross join (select cast(range as int) as k from range(32)) group by 1, 2) group by 1)"""


def _part(base: int, factor: int, modulus: int) -> str:
    return f"concat('0.', lpad(cast({base}+(event_id*{factor})%{modulus} as varchar),3,'0'))"


_QUAD = ", ".join(_part(b, 1, m) for b, m in ((100, 300), (100, 200), (500, 400), (100, 200), (500, 400), (500, 300), (100, 300), (500, 300)))
_TRI = ", ".join(_part(b, 1, m) for b, m in ((100, 300), (100, 200), (500, 400), (300, 200), (200, 400), (600, 300)))
_BOX = ", ".join((_part(100, 1, 800), _part(100, 7, 800), _part(20, 1, 300), _part(20, 3, 300)))
LINES = f"""lines as (
  select event_id, user_id as image_id, case event_id % 11 when 0 then '' when 1 then '0 0.5 0.5' when 2 then '1 0.1 abc 0.3 0.4' when 3 then '0 0.1 0.2 0.3 0.4 0.5' when 4 then '1 0.5 0.5 0 0.2'
    when 5 then '0 1.2 0.5 0.3 0.4' when 6 then concat_ws(' ', '1', {_QUAD}) when 7 then concat_ws(' ', '0', {_TRI}) else concat_ws(' ', cast(event_id%2 as varchar), {_BOX}) end as line from events),
tokens as (select *, case when line = '' then [] else string_split(line, ' ') end as t from lines),
coords as (select *, list_transform(t[2:], lambda x: try_cast(x as double)) as c, len(t) as n_t, try_cast(t[1] as double) as class_value from tokens),
parsed as (select *, len(list_filter(c, lambda x: x is null)) = 0 as numeric_ok from coords)"""

CONVERT = (
    LINES
    + """,
clamped as (select *, list_transform(c, lambda x: case when x is null then null else greatest(0.0::double, least(1.0::double, x)) end) as k from parsed),
corners as (select *, list_min(list_filter(k, lambda x, i: i % 2 = 1)) as x0, list_max(list_filter(k, lambda x, i: i % 2 = 1)) as x1,
  list_min(list_filter(k, lambda x, i: i % 2 = 0)) as y0, list_max(list_filter(k, lambda x, i: i % 2 = 0)) as y1, len(c) as n from clamped),
sized as (select *, case when n = 4 then k[3] else x1 - x0 end as bw, case when n = 4 then k[4] else y1 - y0 end as bh from corners),
judged as (select *, n_t = 0 as blank, case when n_t = 0 then null when n_t < 5 then 'too_few_values' when not numeric_ok then 'non_numeric'
  when n <> 4 and (n < 6 or n % 2 <> 0) then 'invalid_polygon' when bw <= 0 or bh <= 0 then 'invalid_bbox' end as error from sized),
converted as (select event_id, image_id, blank, error, case when not blank and error is null then case when n = 4 then k[1] else x0 + bw / 2 end end as xc,
  case when not blank and error is null then case when n = 4 then k[2] else y0 + bh / 2 end end as yc, case when not blank and error is null then bw end as w, case when not blank and error is null then bh end as h from judged)"""
)

AUDIT = (
    LINES
    + """,
numbered as (select *, row_number() over (partition by image_id order by event_id) as line_number, len(c) as n from parsed),
ends as (select *, case when n = 4 then c[1] - c[3] / 2 else list_min(list_filter(c, lambda x, i: i % 2 = 1)) end as xa, case when n = 4 then c[1] + c[3] / 2 else list_max(list_filter(c, lambda x, i: i % 2 = 1)) end as xb,
  case when n = 4 then c[2] - c[4] / 2 else list_min(list_filter(c, lambda x, i: i % 2 = 0)) end as ya, case when n = 4 then c[2] + c[4] / 2 else list_max(list_filter(c, lambda x, i: i % 2 = 0)) end as yb
  from numbered where n_t >= 5 and numeric_ok and class_value is not null and (n = 4 or (n >= 6 and n % 2 = 0))),
measured as (select *, greatest(xa, xb) - least(xa, xb) as uw, greatest(ya, yb) - least(ya, yb) as uh from ends),
audited as (select event_id, image_id, line_number, cast(trunc(class_value) as int) as class_id, greatest(0.0::double, least(1.0::double, least(xa, xb))) as x_min, greatest(0.0::double, least(1.0::double, least(ya, yb))) as y_min,
  greatest(0.0::double, least(1.0::double, greatest(xa, xb))) as x_max, greatest(0.0::double, least(1.0::double, greatest(ya, yb))) as y_max, greatest(0.0::double, least(1.0::double, uw)) as width,
  greatest(0.0::double, least(1.0::double, uh)) as height, uw / uh as aspect_ratio, n = 4 as is_box from measured where uw > 0 and uh > 0)"""
)

SPLIT_OF = "case when image_id % 10 < 7 then 'train' when image_id % 10 < 9 then 'valid' else 'test' end"

_RATIOS = "ratios as (select * from (values " + ", ".join(f"('{c}', {r[1]!r}::double, {r[2]!r}::double)" for c, _, _, r, _ in GROUPS) + ") as t(grp, rv, rt))"


def _counts(n: str, rv: str, rt: str) -> tuple[str, str, str]:
    v, t = f"greatest(1, cast(round_even({n} * {rv}, 0) as bigint))", f"greatest(1, cast(round_even({n} * {rt}, 0) as bigint))"
    none = f"({n} - {v} - {t} < 1)"
    fv = f"({none} and {v} >= {t} and {v} > 1)"
    ft = f"({none} and not {fv} and {t} > 1)"
    small = lambda a, b, c: f"case when {n} <= 0 then 0 when {n} = 1 then {a} when {n} = 2 then {b} else {c} end"
    return small(1, 1, f"greatest(1, {n} - {v} - {t})"), small(0, 1, f"{v} - cast({fv} as int)"), small(0, 0, f"{t} - cast({ft} as int)")


_TR, _VA, _ = _counts("n", "rv", "rt")
ASSIGNED = (
    SOURCES
    + f""", {_RATIOS},
shuffled as (select s.*, md5(concat('42|', source_key)) as hsh, row_number() over (partition by grp order by md5(concat('42|', source_key)), doc_id) as place, count(*) over (partition by grp) as n from sources s),
assigned as (select x.*, case when place <= {_TR} then 'train' when place <= {_TR} + {_VA} then 'valid' else 'test' end as split from shuffled x left join ratios using (grp)),
grid as (select split, grp from (values ('train'),('valid'),('test')) a(split) cross join (values ('01'),('02'),('03'),('04'),('05')) b(grp))"""
)

_CFG = ", ".join(f"('{c}', {s[0]}, {s[1]!r}::double, {s[2]!r}::double, {str(s[3]).lower()}, {s[4]})" for c, _, _, _, s in GROUPS if s)
TILES = f"""cfg as (select * from (values {_CFG}) t(grp, size, overlap, min_area_ratio, ignore_negative, max_empty)),
images as (select p_partkey as image_id, concat('0', cast(1+p_size%5 as varchar)) as grp, cast(200+(p_partkey*37)%2000 as int) as width, cast(200+(p_partkey*53)%1500 as int) as height from part),
stepped as (select i.*, c.* exclude (grp), greatest(1, cast(round_even(size * (1 - overlap), 0) as int)) as step from images i join cfg c using (grp)),
starts as (select *, case when width <= size then [0] else list_sort(list_distinct(list_concat(range(0, width - size + 1, step), [cast(width - size as bigint)]))) end as xs,
  case when height <= size then [0] else list_sort(list_distinct(list_concat(range(0, height - size + 1, step), [cast(height - size as bigint)]))) end as ys from stepped),
tiles as (select image_id, grp, cast(yi * len(xs) + xi as int) as window_idx, cast(xs[xi + 1] as int) as x0, cast(ys[yi + 1] as int) as y0, cast(least(xs[xi + 1] + size, width) as int) as x1, cast(least(ys[yi + 1] + size, height) as int) as y1,
  ignore_negative, max_empty, min_area_ratio from (select *, unnest(range(len(ys))) as yi from starts) s, lateral (select unnest(range(len(s.xs))) as xi) u)"""

OVERLAPS = (
    BOXES
    + ", "
    + TILES
    + """,
shared as (select t.*, b.event_id, greatest(0, least(t.x1, b.x2) - greatest(t.x0, b.x1)) * greatest(0, least(t.y1, b.y2) - greatest(t.y0, b.y1)) as area_inside,
    (b.x2 - b.x1) * (b.y2 - b.y1) as whole from tiles t join boxes b using (image_id) where b.x1 < t.x1 and b.x2 > t.x0 and b.y1 < t.y1 and b.y2 > t.y0),
overlapping as (select image_id, grp, window_idx, event_id, cast(area_inside as bigint) as area_inside, area_inside::double / whole::double as ratio from shared where area_inside::double / whole::double >= min_area_ratio)"""
)

COCO = """images as (select o_orderkey as image_id, concat('0', cast(1 + o_orderkey % 5 as varchar)) as grp, concat('img_', cast(o_custkey as varchar), '.jpg') as file_name from orders),
annotations as (select l_orderkey as image_id, concat(l_returnflag, l_linestatus) as category, l_quantity as area, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) as ann_pos from lineitem),
first_seen as (select category, min({'a': grp, 'b': image_id, 'c': ann_pos}) as f, count(*) as n from annotations join images using (image_id) group by category),
classes as (select category, cast(row_number() over (order by f) - 1 as int) as class_id, f.a as first_grp, f.b as first_image, n as n_annotations from first_seen)"""

POLYGONS = "polygons as (select vec_id, list_transform(embedding, lambda e: (cast(e as double) + 1) * 320) as f from embeddings)"


def _area(f: str, n: int) -> str:
    return f"abs(list_sum(list_transform(range(0, {n}), lambda i: {f}[2*i+1]*{f}[2*((i+1)%{n})+2] - {f}[2*((i+1)%{n})+1]*{f}[2*i+2]))) / 2"


IOU = (
    BOXES
    + """,
areas as (select d.event_id, d.image_id, d.grp, d.score, t.event_id as gt_id,
    cast(greatest(0, least(d.x2, t.x2) - greatest(d.x1, t.x1)) * greatest(0, least(d.y2, t.y2) - greatest(d.y1, t.y1)) as double) as inter,
    cast((d.x2 - d.x1) * (d.y2 - d.y1) as double) as a, cast((t.x2 - t.x1) * (t.y2 - t.y1) as double) as b from dets d join truth t using (image_id)),
pairs as (select event_id, image_id, grp, score, gt_id, inter / (a + b - inter) as iou from areas where inter > 0),
ranked as (select *, row_number() over (partition by event_id order by iou desc, gt_id) as rn from pairs),
matched as (select d.event_id, d.image_id, d.grp, d.score, r.gt_id, coalesce(r.iou, 0.0::double) as iou from dets d left join (select * from ranked where rn = 1) r using (event_id)),
thresholds as (select cast(range as int) as thr_idx, 0.5::double + range::double * 0.05::double as thr from range(10)),
claims as (select m.*, t.thr_idx, m.gt_id is not null and m.iou >= t.thr as reaches from matched m cross join thresholds t),
flags as (select *, case when reaches and row_number() over (partition by thr_idx, reaches, image_id, gt_id order by score desc, event_id) = 1 then 1 else 0 end as tp from claims),
subsets as (select f.*, s.subset from flags f, lateral (select unnest(['overall', f.grp]) as subset) s),
every as (select distinct image_id, grp from boxes where not (event_type = 'purchase' and grp = 'g03')),
per_image as (select e.image_id, e.grp, (select count(*) from truth t where t.image_id = e.image_id) as gt, (select count(*) from dets d where d.image_id = e.image_id) as n from every e),
sizes as (select subset, cast(count(*) as bigint) as images, cast(sum(gt) as bigint) as gt_objects, cast(sum(n) as bigint) as detections from (select *, unnest(['overall', grp]) as subset from per_image) group by subset),
curve as (select subset, thr_idx, event_id, tp, cast(count(*) over w as bigint) as rank, cast(sum(tp) over w as bigint) as ctp from subsets window w as (partition by subset, thr_idx order by score desc, event_id rows between unbounded preceding and current row))"""
)

AP = (
    IOU
    + """,
cells as (select c.subset, c.thr_idx, cast(floor(100.0::double * ctp / gt_objects) as int) as lvl, max(ctp::double / rank::double) as p from curve c join sizes s using (subset) where tp = 1 group by 1, 2, 3),
levels as (select s.subset, t.thr_idx, g.i, coalesce((select max(p) from cells c where c.subset = s.subset and c.thr_idx = t.thr_idx and c.lvl >= g.i), 0.0::double) as p from sizes s cross join thresholds t cross join (select range as i from range(101)) g),
ap as (select l.subset, l.thr_idx, case when s.gt_objects = 0 then null else round(sum(p order by i) / 101, 9) end as ap, s.gt_objects as n_gt, s.detections as n_det from levels l join sizes s using (subset) group by l.subset, l.thr_idx, s.gt_objects, s.detections)"""
)


def _at_conf(confs: str) -> str:
    return (
        IOU
        + f""",
confs as (select unnest([{confs}]::double[]) as conf),
hits as (select subset, conf, sum(tp) as t, count(*) as k from subsets cross join confs where thr_idx = 0 and score >= conf group by 1, 2),
counted as (select s.subset, c.conf, s.images, s.gt_objects, cast(coalesce(h.t, 0) as bigint) as tp, cast(coalesce(h.k, 0) as bigint) as k from sizes s cross join confs c left join hits h on h.subset = s.subset and h.conf = c.conf),
rated as (select *, k - tp as fp, gt_objects - tp as fn, case when k > 0 then tp::double / k::double else 0.0::double end as precision, case when gt_objects > 0 then tp::double / gt_objects::double else 'NaN'::double end as recall from counted)"""
    )


_RATED = "select subset, conf, tp, fp, fn, precision, recall, case when isnan(recall) then 'NaN'::double when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0.0::double end as f1 from rated"

_IOU_OF = "(greatest(0.0::double, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0.0::double, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1)))"


def _nms(source: str, limit: int) -> str:
    i = _IOU_OF.format(a="k", b="b[1]")
    union = f"((k.x2-k.x1)*(k.y2-k.y1) + (b[1].x2-b[1].x1)*(b[1].y2-b[1].y1) - {i})"
    return f"""grouped as (select image_id, list([{{'event_id': event_id, 'score': score, 'x1': x1::double, 'y1': y1::double, 'x2': x2::double, 'y2': y2::double}}] order by score desc, event_id) as bs from {source} group by image_id),
kept as (select image_id, list_reduce(bs, lambda acc, b: case when len(acc) < {limit} and len(list_filter(acc, lambda k: case when {union} > 0 then {i} / {union} else 0 end > 0.55)) = 0 then list_concat(acc, b) else acc end) as ks from grouped),
suppressed as (select image_id, cast(r as int) as rank, ks[r + 1] as k from kept, lateral (select unnest(range(len(ks))) as r) u)"""


CLOSURE = """near as (select a.doc_id as a, b.doc_id as b from signatures a join signatures b on a.doc_id < b.doc_id and bit_count(xor(a.sig, b.sig)) <= 2),
{more}both_ways as (select a, b from edges union select b, a from edges),
reach(a, b) as (select a, b from both_ways union select r.a, e.b from reach r join both_ways e on r.b = e.a),
clusters as (select a as doc_id, min(least(a, b)) as cluster_id from reach group by a)"""

_KEEP = "row_number() over (partition by cluster_id order by n_ann desc, grp, lower(original_file_name), source_key, doc_id)"

SQL = {
    "coco_image_annotation_join": f"""with {COCO}, cats as (select * from (values ('AF','class_af'),('NF','class_nf'),('NO','class_no'),('RF','class_rf')) t(category, class_name)),
per as (select image_id, count(*) as n, count(distinct class_name) as k, count(*) - count(class_name) as u, sum(area) as a from annotations left join cats using (category) group by image_id)
select image_id, grp, coalesce(n, 0) as n_annotations, coalesce(k, 0) as n_categories, coalesce(u, 0) as n_unknown, coalesce(a, 0.0::double) as total_area, cast(case when n is null then 1 else 0 end as int) as is_background from images left join per using (image_id)""",
    "coco_category_first_seen_ids": f"with {COCO} select * from classes",
    "coco_remapped_annotations": f"with {COCO} select image_id, class_id, count(*) as n, sum(area) as area from annotations join classes using (category) where class_id < 3 group by 1, 2",
    "coco_merge_reid": f"""with {COCO}, parts as (select *, case when image_id % 2 = 0 then 'base' else 'sliced' end as part from images where image_id % 11 <> 0),
named as (select part, image_id, file_name, row_number() over (order by part, image_id) as new_id, row_number() over (partition by file_name order by part, image_id) - 1 as k from parts),
anns as (select n.new_id, row_number() over (order by n.new_id, a.ann_pos) as new_ann_id from annotations a join named n using (image_id)),
per as (select new_id, count(*) as n, min(new_ann_id) as first_ann_id from anns group by new_id)
select new_id, part, image_id as old_id, case when k = 0 then file_name else concat(regexp_replace(file_name, '\\.jpg$', ''), '_', cast(k as varchar), '.jpg') end as file_name, coalesce(n, 0) as n_annotations, first_ann_id from named left join per using (new_id)""",
    "coco_json_documents": f"with {COCO} select image_id, any_value(file_name) as file_name, cast(count(ann_pos) as int) as n_annotations, coalesce(sum(area), 0.0::double) as total_area from images left join annotations using (image_id) group by image_id",
    "source_manifest": f"""with {SOURCES}, i as (select *, row_number() over (partition by grp order by original_file_name, source_key, doc_id) - 1 as source_index from sources)
select grp, source_index, source_key, content_hash, original_file_name, printf('g%s_%06d', grp, source_index) as stable_stem from i""",
    "group_from_name": f"""with {SOURCES}, p as (select doc_id, grp, concat('g', grp, '_', lpad(cast(doc_id as varchar), 6, '0'), case when doc_id % 3 = 0 then '_slice_0001' else '' end, '.jpg') as plain from sources),
n as (select doc_id, grp, case when doc_id % 7 = 0 then concat('x_', plain) when doc_id % 7 = 1 then concat('g', grp, '-', cast(doc_id as varchar)) else plain end as name from p)
select doc_id, name, coalesce(nullif(regexp_extract(name, '^g(\\d{{2}})', 1), ''), 'unknown') as group_code, cast(starts_with(name, concat('g', grp, '_')) as int) as has_prefix, nullif(regexp_extract(name, '^(g\\d{{2}}_\\d{{6}})', 1), '') as source_stem from n""",
    "path_parts": f"""with {SOURCES}, p as (select doc_id, concat('Data/', case when doc_id % 4 = 0 then 'Train' when doc_id % 4 = 1 then 'valid/x' else 'other' end, '/', original_file_name) as path from sources),
q as (select *, string_split(path, '/') as parts from p)
select doc_id, path, array_to_string(parts[:-2], '/') as parent, parts[-1] as base, regexp_replace(parts[-1], '\\.jpg$', '') as stem, '.jpg' as suffix, case when doc_id % 4 = 0 then 'train' when doc_id % 4 = 1 then 'valid' end as split from q""",
    "member_resolution": f"""with {SOURCES}, b as (select doc_id, original_file_name, string_split(original_file_name, '/')[-1] as base from sources)
select doc_id as id, case when doc_id % 5 = 0 then null when doc_id % 3 = 0 then concat('root/images/', base) when doc_id % 3 = 1 then concat('root/', original_file_name) else concat('else/deep/', base) end as member from b""",
    "exact_duplicates": f"""with {SOURCES}, g as (select *, count(*) over (partition by content_hash) as cluster_size, min(source_key) over (partition by content_hash) as cluster,
  row_number() over w as r, first_value(source_key) over w as kept_source_key from sources window w as (partition by content_hash order by n_ann desc, grp, lower(original_file_name), source_key, doc_id))
select doc_id, grp, content_hash, cluster, cluster_size, kept_source_key, case when r = 1 then 'kept' else 'removed' end as action from g where cluster_size > 1""",
    "near_duplicate_pairs": f"with {SIGNATURES} select a.doc_id as doc_a, b.doc_id as doc_b, cast(bit_count(xor(a.sig, b.sig)) as int) as distance from signatures a join signatures b on a.doc_id < b.doc_id and bit_count(xor(a.sig, b.sig)) <= 2",
    "near_duplicate_clusters": f"""with recursive {SOURCES}, {SIGNATURES}, {CLOSURE.format(more="edges as (select * from near), ")},
m as (select c.doc_id, c.cluster_id, s.source_key, g.sig, {_KEEP} as r, count(*) over (partition by cluster_id) as cluster_size from clusters c join sources s using (doc_id) join signatures g using (doc_id)),
k as (select cluster_id, source_key, sig from m where r = 1)
select m.doc_id, m.cluster_id, m.cluster_size, k.source_key as kept_source_key, case when m.r = 1 then 'kept' else 'would_remove' end as action, cast(bit_count(xor(m.sig, k.sig)) as int) as hamming_to_keep from m join k using (cluster_id)""",
    "dedupe_survivors": f"""with recursive {SOURCES}, {SIGNATURES}, {CLOSURE.format(more="edges as (select * from near union select a.doc_id, b.doc_id from sources a join sources b on a.content_hash = b.content_hash and a.doc_id < b.doc_id), ")},
m as (select c.doc_id, {_KEEP} as r from clusters c join sources s using (doc_id))
select doc_id, grp, source_key, n_ann from sources where doc_id not in (select doc_id from m where r > 1)""",
    "duplicate_report_summary": f"""with {SOURCES}, g as (select *, count(*) over (partition by content_hash) as n, row_number() over (partition by content_hash order by n_ann desc, grp, lower(original_file_name), source_key, doc_id) as r from sources)
select coalesce(grp, 'all') as grp, count(*) filter (r = 1) as kept, count(*) filter (r > 1) as removed, count(distinct content_hash) as clusters from g where n > 1 group by rollup(grp)""",
    "split_counts_table": "select n, rv as valid_ratio, rt as test_ratio, {} as train, {} as valid, {} as test from (select range as n from range(201)) cross join (values (0.07::double, 0.06::double), (0.1::double, 0.1::double), (0.45::double, 0.45::double), ({!r}::double, {!r}::double)) r(rv, rt)".format(*_counts("n", "rv", "rt"), 20 / 140, 20 / 140),
    "stratified_split": f"with {ASSIGNED} select doc_id, grp, source_key, split from assigned",
    "split_leakage_violations": f"with {ASSIGNED} select content_hash, count(distinct split) as n_splits, count(*) as n_sources, min(doc_id) as first_doc from assigned group by content_hash having count(distinct split) > 1",
    "split_group_grid_missing": f"""with {ASSIGNED}, c as (select split, grp, count(*) as n from assigned where not (split = 'test' and grp in ('03', '04')) group by 1, 2)
select split, grp, coalesce(n, 0) as n_sources, cast(case when n is null then 1 else 0 end as int) as is_missing from grid left join c using (split, grp)""",
    "split_summary": f"""with {ASSIGNED}, c as (select split, grp, count(*) as a, sum(n_ann) as b from assigned group by 1, 2), f as (select split, grp, coalesce(a, 0) as source_images, cast(coalesce(b, 0) as bigint) as annotations from grid left join c using (split, grp))
select *, cast(sum(source_images) over (partition by split) as bigint) as total_images_in_split, cast(sum(annotations) over (partition by split) as bigint) as total_annotations_in_split from f""",
    "audit_split_group_summary": f"""with {ASSIGNED}, c as (select split, grp, count(*) as i, sum(n_ann) as o, count(*) filter (n_ann = 0) as b from assigned group by 1, 2)
select split, grp, coalesce(i, 0) as images, cast(coalesce(o, 0) as bigint) as objects, coalesce(b, 0) as background_images, coalesce(round(b::double / i::double, 4), 0.0::double) as background_ratio, coalesce(round(o::double / i::double, 4), 0.0::double) as objects_per_image from grid left join c using (split, grp)""",
    "stratified_sample": f"""with {ASSIGNED}, r as (select *, cast(n_ann = 0 as int) as is_background, row_number() over (partition by grp, n_ann = 0 order by hsh, doc_id) as r from assigned where split = 'train'),
p as (select *, row_number() over (partition by grp order by is_background, r) as position from r where r <= 6 and (is_background = 1 or r <= 4))
select grp, cast(position as int) as position, doc_id, source_key, is_background from p where position <= 6""",
    "tile_windows": f"with {TILES} select image_id, grp, window_idx, x0, y0, x1, y1 from tiles",
    "tile_box_overlap": f"with {OVERLAPS} select * from overlapping",
    "empty_tile_cap": f"""with {OVERLAPS}, n as (select image_id, window_idx, count(*) as k from overlapping group by 1, 2),
t as (select t.*, coalesce(k, 0) as n_ann, printf('g%s_%06d_slice_%04d.jpg', grp, image_id, window_idx) as file_name from tiles t left join n using (image_id, window_idx)),
r as (select *, row_number() over (partition by substring(file_name, 1, 10), n_ann = 0 order by file_name) as r from t where not (ignore_negative and n_ann = 0))
select image_id, window_idx, file_name, n_ann from r where n_ann > 0 or r <= max_empty""",
    "polygon_area": f"with {POLYGONS} select vec_id, round({_area('f', 32)}, 5) as area from polygons",
    "polygon_bbox": f"""with {POLYGONS}, e as (select vec_id, list_filter(f, lambda v, i: i % 2 = 1) as xs, list_filter(f, lambda v, i: i % 2 = 0) as ys from polygons),
c as (select vec_id, least(greatest(list_min(xs), 0.0::double), 330.0::double) as x0, least(greatest(list_max(xs), 0.0::double), 330.0::double) as x1, least(greatest(list_min(ys), 0.0::double), 330.0::double) as y0, least(greatest(list_max(ys), 0.0::double), 330.0::double) as y1 from e)
select vec_id, x0 as x, y0 as y, x1 - x0 as w, y1 - y0 as h from c""",
    "largest_polygon": f"""with {POLYGONS}, p as (select vec_id, cast(k as int) as k, f[16*k+1:16*k+16] as g from polygons, lateral (select unnest(range(4)) as k) u), a as (select vec_id, k, {_area('g', 8)} as area from p)
select vec_id, k as polygon_idx, round(area, 5) as area from (select *, row_number() over (partition by vec_id order by area desc, k) as r from a) where r = 1""",
    "polygon_to_box": f"""with {POLYGONS}, e as (select vec_id, list_transform(f, lambda v: greatest(0.0::double, least(1.0::double, v / 640))) as c from polygons),
b as (select vec_id, list_min(list_filter(c, lambda v, i: i % 2 = 1)) as x0, list_max(list_filter(c, lambda v, i: i % 2 = 1)) as x1, list_min(list_filter(c, lambda v, i: i % 2 = 0)) as y0, list_max(list_filter(c, lambda v, i: i % 2 = 0)) as y1 from e)
select vec_id, x0 + (x1 - x0) / 2 as xc, y0 + (y1 - y0) / 2 as yc, x1 - x0 as w, y1 - y0 as h from b""",
    "difference_hashes": """with b as (select vec_id, i, case when embedding[(i // 8) * 9 + i % 8 + 1] > embedding[(i // 8) * 9 + i % 8 + 2] then 1 else 0 end as bit from embeddings, (select range as i from range(56))),
h as (select vec_id, cast(sum(bit::bigint << (55 - i)::int) as bigint) as dhash, cast(sum(bit) as int) as n_bits from b group by vec_id)
select vec_id, dhash, lpad(lower(to_hex(dhash)), 16, '0') as hex, cast(0 as int) as round_trip, n_bits from h""",
    "label_parse_convert": f"with {CONVERT} select event_id, cast(blank as int) as blank, error, xc, yc, w, h from converted",
    "label_parse_audit": f"with {AUDIT} select event_id, class_id, x_min, y_min, x_max, y_max, width, height, width * height as area, aspect_ratio from audited",
    "label_parse_eval": f"""with {LINES} select event_id, greatest(0.0::double, least(640.0::double, (c[1] - c[3] / 2) * 640)) as x1, greatest(0.0::double, least(480.0::double, (c[2] - c[4] / 2) * 480)) as y1,
  greatest(0.0::double, least(640.0::double, (c[1] + c[3] / 2) * 640)) as x2, greatest(0.0::double, least(480.0::double, (c[2] + c[4] / 2) * 480)) as y2 from parsed where n_t = 5 and numeric_ok""",
    "conversion_summary": f"""with {CONVERT}, per as (select image_id, count(*) filter (not blank and error is null) as objects, count(*) filter (error = 'too_few_values') as a, count(*) filter (error = 'non_numeric') as b, count(*) filter (error = 'invalid_polygon') as c, count(*) filter (error = 'invalid_bbox') as d from converted group by image_id)
select coalesce(split, 'overall') as split, count(*) as images, cast(sum(objects) as bigint) as objects, count(*) filter (objects = 0) as background_images, cast(sum(a) as bigint) as skipped_too_few_values, cast(sum(b) as bigint) as skipped_non_numeric, cast(sum(c) as bigint) as skipped_invalid_polygon, cast(sum(d) as bigint) as skipped_invalid_bbox
from (select *, {SPLIT_OF} as split from per) group by rollup(split)""",
    "label_validation_counts": f"""with {LINES}, v as (select case when n_t = 0 then null when n_t <> 5 then 'token_count' when t[1] <> '0' then 'class' when not numeric_ok then 'number'
  when len(list_filter(c, lambda x: x < 0 or x > 1)) > 0 then 'range' when c[3] <= 0 or c[4] <= 0 then 'size' end as rule from parsed) select rule, count(*) as n from v where rule is not null group by rule""",
    "audit_image_rows": f"with {AUDIT}, n as (select image_id, count(*) as k from audited group by 1) select i.image_id, {SPLIT_OF} as split, coalesce(k, 0) as objects, cast(case when k is null then 1 else 0 end as int) as is_background from (select distinct image_id from lines) i left join n using (image_id)",
    "audit_object_rows": f"with {AUDIT} select image_id, event_id, cast(line_number as int) as line_number, class_id, width, height, width * height as area, cast(is_box as int) as is_box from audited",
    "class_distribution": f"with {AUDIT}, n as (select class_id, count(*) as k from audited group by 1) select class_id, class_name, coalesce(k, 0) as n_objects from (values (0, 'smoke'), (1, 'fire'), (2, 'other')) c(class_id, class_name) left join n using (class_id)",
    "iou_pairs": f"with {IOU} select image_id, event_id, gt_id, iou from pairs",
    "nms_kept": f"with {BOXES}, {_nms('dets', 300)} select image_id, k.event_id as event_id, rank, k.score as score from suppressed",
    "merge_tile_predictions": f"""with {BOXES}, moved as (select event_id, image_id, score, x1 + case when event_id % 2 = 0 then event_id % 3 * 300 else 0 end as x1, y1 as y1, x2 + case when event_id % 2 = 0 then event_id % 3 * 300 else 0 end as x2, y2 from dets),
clipped as (select event_id, image_id, score, least(1000, x1) as x1, y1, least(1000, x2) as x2, y2 from moved), usable as (select * from clipped where x2 > x1 and y2 > y1),
{_nms('usable', 40)} select image_id, k.event_id as event_id, rank, k.x1 as x1, k.y1 as y1, k.x2 as x2, k.y2 as y2 from suppressed""",
    "match_tp_fp": f"with {IOU} select event_id, image_id, thr_idx, gt_id, iou, tp from flags where thr_idx in (0, 5)",
    "pr_curve": f"with {IOU} select c.subset, event_id, rank, ctp, ctp::double / rank::double as precision, ctp::double / gt_objects::double as recall from curve c join sizes s using (subset) where thr_idx = 0 and gt_objects > 0",
    "eval_ap_by_subset": f"with {AP} select subset, thr_idx, ap, n_gt, n_det from ap",
    "eval_map_summary": f"with {AP} select s.subset, images, gt_objects, detections, max(ap) filter (thr_idx = 0) as map50, round(avg(ap), 8) as map50_95 from sizes s join ap using (subset) group by 1, 2, 3, 4",
    "precision_recall_at_conf": f"with {_at_conf('0.25')} {_RATED}",
    "conf_threshold_sweep": f"with {_at_conf('0.05, 0.1, 0.25, 0.4, 0.5, 0.75, 0.9')} {_RATED}",
    "false_positives_per_image": f"with {_at_conf('0.25')} select subset, images, fp, fp::double / images::double as fp_per_image from rated",
    "area_histogram": f"""with {BOXES}, v as (select greatest(1e-8::double, 100.0::double * ((x2 - x1) * (y2 - y1))::double / 1000000.0::double) as v from truth), e as (select min(v) as lo, max(v) as hi from v),
b as (select case when hi > lo then least(59, cast(floor((v - lo) / (hi - lo) * 60) as int)) else 0 end as bin from v cross join e), n as (select bin, count(*) as k from b group by 1)
select cast(range as int) as bin, coalesce(k, 0) as n_boxes from range(60) left join n on n.bin = range""",
    "tabulated_detections": f"with {BOXES} select image_id, event_id, cast(row_number() over (partition by image_id order by score desc, event_id) as int) as rank, round(score, 4) as confidence, x1::double as x1, y1::double as y1, x2::double as x2, y2::double as y2 from dets",
    "best_epoch": "with e as ({E}) select stage, epoch as best_epoch, coalesce(precision, 'NaN'::double) as precision, coalesce(recall, 'NaN'::double) as recall, coalesce(mAP50, 'NaN'::double) as mAP50, coalesce(mAP50_95, 'NaN'::double) as mAP50_95 from (select *, row_number() over (partition by stage order by coalesce(mAP50, '-Infinity'::double) desc, epoch) as r from e) where r = 1",
    "stage_comparison": "with e as ({E}) select stage, epoch, metric, value from (unpivot e on precision, recall, mAP50, mAP50_95 into name metric value value)",
}

_EPOCHS = """select stage, epoch, case when p + s <> 0 then p::double / (p + s)::double end as precision, (p + s)::double / n::double as recall, p::double / n::double as mAP50, s::double / n::double as mAP50_95 from (
  select case when user_id % 2 = 0 then 'Stage 1' else 'Stage 2' end as stage, cast(extract(day from ts) as int) as epoch, count(*) as n, count(*) filter (event_type = 'purchase') as p, count(*) filter (event_type = 'signup') as s from events group by 1, 2)"""
for _name in ("best_epoch", "stage_comparison"):
    SQL[_name] = SQL[_name].replace("{E}", _EPOCHS)
