"""DuckDB SQL for the queries of the dataset build, and for polygon clipping."""

from __future__ import annotations

from .oracle import _EPOCHS, _KEEP, AP, ASSIGNED, AUDIT, BOXES, CLOSURE, COCO, CONVERT, LINES, POLYGONS, SIGNATURES, SOURCES, SPLIT_OF, TILES

POINT = "struct(x double, y double)[]"


def _pass(name: str, before: str, axis: str, bound: str, above: bool) -> str:
    """One edge of a window: corners inside stay, and where the outline crosses the edge a corner comes in."""
    other, sign = ("y", ">=" if above else "<=") if axis == "x" else ("x", ">=" if above else "<=")
    last = "p[case when i = 1 then len(p) else i - 1 end]"
    d = f"(p[i].{axis} - {last}.{axis})"
    across = f"case when abs({d}) < 1e-9 then {last}.{other} else {last}.{other} + ({bound} - {last}.{axis}) / {d} * (p[i].{other} - {last}.{other}) end"
    cut = f"{{'x': {bound}::double, 'y': {across}}}" if axis == "x" else f"{{'x': {across}, 'y': {bound}::double}}"
    here, there = f"p[i].{axis} {sign} {bound}", f"{last}.{axis} {sign} {bound}"
    return f"""{name} as (select * replace (flatten(list_transform(range(1, len(p) + 1), lambda i: case when {here} and {there} then [p[i]] when {here} then [{cut}, p[i]] when {there} then [{cut}] else []::{POINT} end))::{POINT} as p) from {before})"""


def _clip(source: str) -> str:
    """CTEs from `source` (..., p, x0, y0, x1, y1) to `clipped`, p held inside the window, with its area."""
    passes = [_pass("cut1", source, "x", "x0", True), _pass("cut2", "cut1", "x", "x1", False), _pass("cut3", "cut2", "y", "y0", True), _pass("cut4", "cut3", "y", "y1", False)]
    held = "held as (select * replace (list_transform(p, lambda q: {'x': least(greatest(q.x, x0::double), x1::double), 'y': least(greatest(q.y, y0::double), y1::double)}) as p) from cut4)"
    term = "p[i].x * p[i % len(p) + 1].y - p[i % len(p) + 1].x * p[i].y"
    area = f"clipped as (select *, case when len(p) < 3 then 0.0::double else abs(list_sum(list_transform(range(1, len(p) + 1), lambda i: {term}))) / 2 end as area from held)"
    return ",\n".join([*passes, held, area])


def _points(f: str) -> str:
    return f"list_transform(range(0, len({f}) // 2), lambda i: {{'x': {f}[2*i+1], 'y': {f}[2*i+2]}})"


def _shoelace(f: str) -> str:
    n = f"(len({f}) // 2)"
    return f"case when {n} < 3 then 0.0::double else abs(list_sum(list_transform(range(0, {n}), lambda i: {f}[2*i+1]*{f}[2*((i+1)%{n})+2] - {f}[2*((i+1)%{n})+1]*{f}[2*i+2]))) / 2 end"


ANNOTATIONS = """flats as (select vec_id, label, list_transform(embedding, lambda e: (cast(e as double) + 1) * 320) as f from embeddings),
anns as (select vec_id as ann_id, vec_id * 4 % 400 as image_id, case when label % 5 < 4 then 'class ' || (label % 5)::varchar else 'unknown' end as category, case when label % 5 < 4 then label % 5 end as class_id,
  case vec_id % 4 when 0 then [f] when 1 then [f[1:32], f[33:64]] when 2 then [f[1:16], f[17:32], f[33:48], f[49:64]]
    else case when f[3] - 300 > 1 and f[4] - 300 > 1 then [[f[1], f[2], f[1] + f[3] - 300, f[2], f[1] + f[3] - 300, f[2] + f[4] - 300, f[1], f[2] + f[4] - 300]] else []::double[][] end end as polygons from flats)"""

CLIPPED = f"""{TILES}, {ANNOTATIONS},
facts as (select *, list_min(list_filter(flatten(polygons), lambda v, i: i % 2 = 1)) as l, list_max(list_filter(flatten(polygons), lambda v, i: i % 2 = 1)) as r,
  list_min(list_filter(flatten(polygons), lambda v, i: i % 2 = 0)) as t, list_max(list_filter(flatten(polygons), lambda v, i: i % 2 = 0)) as b,
  coalesce(list_sum(list_transform(polygons, lambda f: {_shoelace('f')})), 0) as whole from anns),
met as (select t.*, a.ann_id, a.whole, unnest(a.polygons) as f, generate_subscripts(a.polygons, 1) as k from tiles t join facts a using (image_id) where a.l < t.x1 and a.r > t.x0 and a.t < t.y1 and a.b > t.y0),
pointed as (select * exclude (f), {_points('f')} as p from met),
{_clip('pointed')},
parts as (select * from clipped where len(p) >= 3 and area > 1),
summed as (select image_id, grp, window_idx, x0, y0, x1, y1, ignore_negative, max_empty, min_area_ratio, ann_id, whole, count(*) as n_polygons, sum(len(p) * 2) as n_numbers, sum(area order by k) as area,
  min(list_min(list_transform(p, lambda q: q.x - x0))) as l, max(list_max(list_transform(p, lambda q: q.x - x0))) as r, min(list_min(list_transform(p, lambda q: q.y - y0))) as t, max(list_max(list_transform(p, lambda q: q.y - y0))) as b
  from parts group by all),
boxed as (select * replace (least(greatest(l, 0.0::double), (x1 - x0)::double) as l, least(greatest(r, 0.0::double), (x1 - x0)::double) as r, least(greatest(t, 0.0::double), (y1 - y0)::double) as t, least(greatest(b, 0.0::double), (y1 - y0)::double) as b)
  from summed where whole > 0 and area / whole >= min_area_ratio),
kept_anns as (select * from boxed where r - l > 1 and b - t > 1)"""

SLICES = (
    CLIPPED.replace("from images i join cfg c using (grp))", "from (select * from images where image_id % 10 < 7) i join cfg c using (grp))")
    + """,
per_tile as (select image_id, window_idx, count(*) as n from kept_anns group by 1, 2),
full_tiles as (select t.*, coalesce(n, 0) as n_ann, printf('g%s_%06d_slice_%04d.jpg', grp, image_id, window_idx) as file_name from tiles t left join per_tile using (image_id, window_idx)),
ranked_tiles as (select *, row_number() over (partition by image_id, n_ann = 0 order by file_name) as place from full_tiles where not (ignore_negative and n_ann = 0)),
slices as (select * from ranked_tiles where n_ann > 0 or place <= max_empty)"""
)

BUILD = f"""{ANNOTATIONS},
placed as (select p_partkey as image_id, concat('0', cast(1+p_size%5 as varchar)) as grp, cast(200+(p_partkey*37)%2000 as int) as width, cast(200+(p_partkey*53)%1500 as int) as height from part),
sourced as (select *, case when image_id % 10 < 7 then 'train' when image_id % 10 < 9 then 'valid' else 'test' end as split, substring(sha1(concat_ws('|', grp, image_id::varchar)), 1, 16) as source_key, 'photo ' || image_id::varchar as original_file_name,
  printf('g%s_%06d', grp, image_id) || case image_id % 3 when 0 then '.png' when 1 then '.jpg' else '.jpeg' end as file_name from placed),
numbered_images as (select *, row_number() over (partition by split order by grp, image_id) as id from sourced),
numbered_anns as (select a.*, i.split, i.id as new_image, row_number() over (partition by i.split order by i.id, a.ann_id) as id from anns a join numbered_images i using (image_id) where a.class_id is not null)"""

SIZED = """audited_images as (select i.image_id, case when i.image_id % 10 < 7 then 'train' when i.image_id % 10 < 9 then 'valid' else 'test' end as split, '0' || (1 + i.image_id % 5)::varchar as grp, coalesce(k, 0) as objects
  from (select distinct image_id from lines) i left join (select image_id, count(*) as k from audited group by 1) n using (image_id)),
totals as (select coalesce(split, 'all') as split, coalesce(grp, 'all') as grp, count(*) as images, sum(objects)::bigint as objects, count(*) filter (objects = 0) as background_images from audited_images group by rollup(split, grp)),
shared as (select *, printf('%.2f', (background_images::double / images::double) * 100) || '%' as background_share from totals)"""

CLUSTERS = f"""{SOURCES}, {SIGNATURES}, {CLOSURE.format(more="edges as (select * from near union select a.doc_id, b.doc_id from sources a join sources b on a.content_hash = b.content_hash and a.doc_id < b.doc_id), ")},
m as (select c.cluster_id, s.*, {_KEEP} as r, count(*) over (partition by cluster_id) as cluster_size from clusters c join sources s using (doc_id)),
heads as (select cluster_id, cluster_size, row_number() over (order by cluster_size desc, grp, cluster_id) as cluster_number from m where r = 1)"""

EXACT = f"""{SOURCES}, full_sources as (select s.*, cast(320 + d.n_chars % 1600 as int) as width, cast(240 + (d.n_chars*7) % 900 as int) as height, 'raw/' || d.source || '/' || d.doc_id::varchar || '.jpg' as path from sources s join documents d using (doc_id)),
g as (select *, count(*) over (partition by content_hash) as n, row_number() over w as r, first_value(source_key) over w as kept_source_key from full_sources window w as (partition by content_hash order by n_ann desc, grp, lower(original_file_name), source_key, doc_id))"""

_BEST = "select stage, epoch as best_epoch, coalesce(precision, 'NaN'::double) as precision, coalesce(recall, 'NaN'::double) as recall, coalesce(mAP50, 'NaN'::double) as mAP50, coalesce(mAP50_95, 'NaN'::double) as mAP50_95 from (select *, row_number() over (partition by stage order by coalesce(mAP50, '-Infinity'::double) desc, epoch) as r from e) where r = 1"

_NAMES = "names as (select n, case n when 0 then 'path: .' when 1 then 'train: images/train' when 2 then 'val: images/valid' when 3 then 'test: images/test' else 'names:' end as line from range(5) t(n))"

_HEADER = "case when doc_id % 4 = 3 then 0 else {} end"

SQL = {
    "polygon_clip_tile": f"""with {POLYGONS}, windows as (select * from (values (0, 0, 0, 320, 320), (1, 320, 0, 640, 320), (2, 0, 320, 320, 640), (3, 320, 320, 640, 640)) t(window_idx, x0, y0, x1, y1)),
facts as (select vec_id, f, {_shoelace('f')} as whole, list_min(list_filter(f, lambda v, i: i % 2 = 1)) as l, list_max(list_filter(f, lambda v, i: i % 2 = 1)) as r, list_min(list_filter(f, lambda v, i: i % 2 = 0)) as t, list_max(list_filter(f, lambda v, i: i % 2 = 0)) as b from polygons),
pointed as (select vec_id, whole, w.*, {_points('f')} as p from facts join windows w on l < x1 and r > x0 and t < y1 and b > y0),
{_clip('pointed')},
spans as (select *, list_max(list_transform(p, lambda q: q.x)) - list_min(list_transform(p, lambda q: q.x)) as w, list_max(list_transform(p, lambda q: q.y)) - list_min(list_transform(p, lambda q: q.y)) as h from clipped)
select vec_id, window_idx, len(p)::int as n_points, round(area, 5) as area, round(w, 6) as w, round(h, 6) as h from spans where len(p) >= 3 and area > 1 and whole > 0 and area / whole >= 0.1 and w > 1 and h > 1""",
    "near_duplicate_pairs": f"""with {SIGNATURES}, reps as (select sig, min(doc_id) as f, count(*) as n from signatures group by sig)
select a.f as doc_a, b.f as doc_b, a.n as n_a, b.n as n_b, cast(bit_count(xor(a.sig, b.sig)) as int) as distance from reps a join reps b on a.f < b.f and bit_count(xor(a.sig, b.sig)) <= 2""",
    "annotation_discovery": """with listed as (select distinct '0' || (1 + doc_id % 5)::varchar as grp, doc_id % 7 as kind from documents)
select grp, case kind when 0 then '_annotations.coco.json' when 1 then 'train/_annotations.json' else 'valid/_annotations.coco-segmentation.json' end as annotation, case kind when 0 then '' when 1 then case when exists (select 1 from listed o where o.grp = l.grp and o.kind = 2) then 'train/images' else 'train' end else 'valid' end as image_dir,
  case kind when 0 then 1 when 1 then 13 else 22 end::int as place from listed l where kind in (0, 1, 3)""",
    "extraction_names": """with i as (select 'g' || (doc_id % 5)::varchar as archive, case (doc_id // 5) % 4 when 0 then 'train/_annotations.coco.json' when 1 then 'valid/_annotations.coco.json' when 2 then 'x/train/_annotations.json' else '_annotations.json' end as annotation, doc_id // 20 as pos,
  lang || ' ' || doc_id::varchar || case doc_id % 3 when 0 then '.JPG' when 1 then '.gif' else '' end as name, case when doc_id % 9 > 0 then 'm/' || doc_id::varchar || case doc_id % 2 when 0 then '.png' else '.dat' end end as member, doc_id from documents),
a as (select *, row_number() over (partition by archive order by annotation) as n from (select distinct archive, annotation from i))
select archive, annotation, case annotation when 'train/_annotations.coco.json' then 'train' when 'valid/_annotations.coco.json' then 'valid' when 'x/train/_annotations.json' then printf('part_%02d', n) else '' end as folder,
  printf('img_%02d_%06d', n, pos + 1) || case when doc_id % 3 = 0 then '.jpg' when doc_id % 2 = 0 then '.png' else '.jpg' end as file_name, name as original_file_name, member from i join a using (archive, annotation) where member is not null""",
    "image_listing": """with l as (select distinct '0' || (1 + doc_id % 5)::varchar as grp, doc_id, doc_id % 7 as k from documents where doc_id % 7 in (2, 5))
select grp, case k when 2 then 'train/images/' || doc_id::varchar || '.jpg' else 'valid/' || doc_id::varchar || '.WEBP' end as path, doc_id::varchar as stem, case k when 2 then '.jpg' else '.webp' end as suffix from l""",
    "image_path_resolution": """select doc_id as id, case when doc_id % 5 = 0 then 'a/b' || (doc_id % 3)::varchar || '/sub/' || doc_id::varchar || '.jpg' when doc_id % 5 = 1 then 'a/b' || (doc_id % 3)::varchar || '/' || doc_id::varchar || '.jpg'
  when doc_id % 5 = 2 then 'a/sub/' || doc_id::varchar || '.jpg' when doc_id % 5 = 3 then 'a/' || doc_id::varchar || '.jpg' end as path from documents""",
    "image_header_sizes": f"with s as (select doc_id, cast(320 + n_chars % 1600 as int) as w, cast(240 + (n_chars*7) % 900 as int) as h from documents) select doc_id, {_HEADER.format('w')} as width, {_HEADER.format('h')} as height from s",
    "coco_scan": """with i as (select doc_id, '0' || (1 + doc_id % 5)::varchar as grp, 'doc' || (doc_id % 10)::varchar as doc, doc_id % 10 // 5 as place, doc_id // 10 as pos, 'i' || doc_id::varchar || '.jpg' as name, doc_id % 13 = 0 as bare from documents
  where doc_id % 17 <> 0 and doc_id % 19 <> 0 and doc_id % 7 <> 0 and not (doc_id % 13 = 0 and doc_id % 26 = 0)),
n as (select *, row_number() over (partition by grp order by place, pos) as source_index from i)
select grp, source_index, 'd' || (doc_id % 10)::varchar || '/' || name as path, name as original_file_name, cast(case when bare then 640 else 100 + doc_id % 50 end as int) as width, cast(case when bare then 480 else 80 + doc_id % 40 end as int) as height,
  substring(sha1(concat_ws('|', grp, doc, doc_id::varchar, name)), 1, 16) as source_key, sha1(doc_id::varchar) as content_hash, (doc_id % 3)::bigint as n_annotations, (case when doc_id % 4 in (1, 3) then doc_id % 3 else 0 end)::bigint as n_unknown from n""",
    "raw_sources_with_hash": f"""with {SOURCES}, b as (select vec_id, i, case when embedding[(i // 8) * 9 + i % 8 + 1] > embedding[(i // 8) * 9 + i % 8 + 2] then 1 else 0 end as bit from embeddings, (select range as i from range(56))),
h as (select vec_id, cast(sum(bit::bigint << (55 - i)::int) as bigint) as d from b group by vec_id)
select s.doc_id, grp, source_key, original_file_name, 'raw/' || source || '/' || s.doc_id::varchar || '.jpg' as path, n_ann as annotations, content_hash, lpad(lower(to_hex(d)), 16, '0') as dhash from sources s join documents using (doc_id) join h on h.vec_id = s.doc_id""",
    "evaluation_records": f"""with {LINES}, i as (select p_partkey as image_id, cast(200+(p_partkey*37)%2000 as int) as width, cast(200+(p_partkey*53)%1500 as int) as height from part),
t as (select image_id, count(*) as n, string_agg(line, '|' order by event_id) as text from lines where line <> '' group by 1)
select {SPLIT_OF} as dir, printf('g0%d_%06d', 1 + image_id % 5, image_id) as stem, '0' || (1 + image_id % 5)::varchar as grp, width, height, coalesce(n, 0)::int as n_lines, coalesce(text, '') as text from i left join t using (image_id)""",
    "dataset_location": "select 'data/' || n_name as dir from nation where n_nationkey > 6 order by n_nationkey limit 1",
    "group_inputs": "select '0' || k::varchar as grp, case when k = 4 then 'given/path' else '0' || k::varchar || '_export' end as input from range(1, 6) t(k)",
    "segmentation_polygons": """with s as (select vec_id, vec_id % 7 as k, vec_id::double as v, vec_id % 21 > 1 and vec_id % 5 > 1 as usable, (vec_id % 21)::double as w, (vec_id % 5)::double as h from embeddings)
select vec_id, case k when 0 then usable::int when 1 then 1 when 2 then 1 when 3 then 1 when 5 then 2 else 0 end::int as n_polygons,
  case k when 0 then case when usable then w * h else 0 end when 1 then v * 10 / 2 when 2 then v * 10 / 2 when 5 then abs(4 * v) / 2 + v * v else 0 end::double as area, case k when 0 then case when usable then 8 else 0 end when 1 then 6 when 2 then 6 when 5 then 14 else 0 end::int as n_numbers from s""",
    "bom_text": f"with {SOURCES} select doc_id, original_file_name as name, (length(original_file_name) + 11)::int as n_chars from sources",
    "normalised_values": """with d as (select doc_id, ((doc_id * 37) % 1500 - 200)::double as v, doc_id % 4 * 300 as size from documents), n as (select *, case when size <= 0 then 0.0::double else greatest(0.0::double, least(1.0::double, v / size)) end as value from d)
select doc_id, value, printf('%.6f', value) as text, case when doc_id % 3 = 0 then null else 'x' end as name from n""",
    "split_coco_images": f"with {BUILD} select split, id, file_name, width, height, grp, source_key, original_file_name from numbered_images",
    "split_coco_annotations": f"with {BUILD} select split, id, new_image as image_id, class_id, len(polygons)::int as n_polygons from numbered_anns",
    "split_build_of_groups": f"""with {BUILD}, chosen as (select *, row_number() over (partition by split order by grp, image_id) as new_id from sourced where grp in ('02', '04')), n as (select image_id, count(*) as k from anns where class_id is not null group by 1)
select split, new_id as id, file_name, coalesce(k, 0) as n_annotations from chosen left join n using (image_id)""",
    "coco_document": f"""with {BUILD}, heads as (select * from (values (0, 0, '{{"images":['), (2, 0, '],"annotations":['), (4, 0, '],"categories":['), (6, 0, ']}}')) t(section, n, line))
select section::int as section, n::bigint as n, line from heads
union all select 1, id, case when id > 1 then ',' else '' end || '{{"id":' || id::varchar || ',"file_name":"' || file_name || '","width":' || width::varchar || ',"height":' || height::varchar || '}}' from numbered_images where split = 'valid'
union all select 3, id, case when id > 1 then ',' else '' end || '{{"id":' || id::varchar || ',"image_id":' || new_image::varchar || ',"category_id":' || class_id::varchar || '}}' from numbered_anns where split = 'valid'
union all select 5, k, case when k > 0 then ',' else '' end || '{{"id":' || k::varchar || ',"name":"class ' || k::varchar || '"}}' from range(4) t(k)""",
    "clipped_annotations": f"with {CLIPPED} select image_id, window_idx, ann_id, n_polygons::int as n_polygons, n_numbers::int as n_numbers, round(area, 5) as area, round(l, 6) as x, round(t, 6) as y, round(r - l, 6) as w, round(b - t, 6) as h from kept_anns",
    "train_slices": f"with {SLICES} select image_id, window_idx, file_name, n_ann, x1 - x0 as width, y1 - y0 as height from slices",
    "train_slice_annotations": f"with {SLICES} select k.image_id, k.window_idx, k.ann_id, round(k.area, 5) as area from kept_anns k join slices using (image_id, window_idx)",
    "train_merged": f"""with {SLICES}, base as (select '0' as part, image_id as key, image_id, -1 as window_idx, printf('g%s_%06d', grp, image_id) as file_name from images where image_id % 10 < 7),
every as (select * from base union all select 'g' || grp, image_id * 10000 + window_idx, image_id, window_idx, file_name from slices),
new as (select *, row_number() over (order by part, key) as new_id from every),
all_anns as (select n.new_id, a.ann_id from new n join anns a on n.part = '0' and a.image_id = n.image_id union all select n.new_id, k.ann_id from new n join kept_anns k on n.part <> '0' and k.image_id = n.image_id and k.window_idx = n.window_idx),
ids as (select new_id, row_number() over (order by new_id, ann_id) as new_ann_id from all_anns), per as (select new_id, count(*) as n, min(new_ann_id) as first_ann_id from ids group by 1)
select new_id, part, file_name, coalesce(n, 0) as n_annotations, first_ann_id from new left join per using (new_id)""",
    "segmentation_labels": f"""with {BUILD}, known as (select a.*, i.width, i.height, row_number() over (partition by a.image_id order by a.ann_id) as line_number from anns a join placed i using (image_id) where class_id is not null),
sized as (select *, list_transform(polygons, lambda f: {_shoelace('f')}) as areas from known),
picked as (select *, polygons[list_position(areas, list_max(areas))] as f from sized)
select image_id, line_number::int as line_number, case when len(polygons) > 0 then class_id::varchar || ' ' || array_to_string(list_transform(f, lambda v, i: printf('%.6f', greatest(0.0::double, least(1.0::double, v / case when i % 2 = 1 then width else height end)))), ' ') end as line from picked""",
    "skipped_annotations": f"with {BUILD} select count(*) filter (len(polygons) > 0) as written, count(*) filter (len(polygons) = 0) as rle_or_missing_segmentation from anns join placed using (image_id) where class_id is not null",
    "detection_labels": f"with {CONVERT} select event_id, printf('0 %.6f %.6f %.6f %.6f', xc, yc, w, h) as line from converted where not blank and error is null",
    "duplicate_report": f"""with {EXACT} select content_hash, '' as perceptual_hash, case when r = 1 then 'kept' else 'removed' end as action, grp, source_key, original_file_name, path, n_ann as annotations, width, height, kept_source_key,
  cast(row_number() over (partition by content_hash order by r > 1, grp, original_file_name, source_key) as int) as position from g where n > 1""",
    "duplicate_report_read_back": f"""with {EXACT}, d as (select * from g where n > 1), b as (select grp, count(*) as k from d where r > 1 group by grp)
select count(distinct kept_source_key) as clusters, count(*) filter (r = 1) as kept, count(*) filter (r > 1) as removed, (select coalesce(string_agg(grp || ':' || k::varchar, ' ' order by grp), '') from b) as removed_by_group from d""",
    "near_cluster_numbers": f"with recursive {CLUSTERS} select cluster_id, cluster_size, cluster_number from heads",
    "near_cluster_sheets": f"""with recursive {CLUSTERS}, p as (select h.cluster_number, m.*, cast(row_number() over (partition by cluster_id order by r > 1, m.grp, original_file_name, source_key) as int) as position from m join heads h using (cluster_id) where h.cluster_number <= 24)
select cluster_number, position, doc_id, case when r = 1 then 'kept' else 'would_remove' end as action, grp, n_ann from p where position <= 8""",
    "near_cluster_summary": f"with recursive {CLUSTERS} select coalesce(grp, 'all') as grp, count(*) filter (r > 1) as would_remove, count(*) filter (r = 1) as clusters from m group by rollup(grp)",
    "dataset_totals": f"with {AUDIT}, {SIZED} select * from shared",
    "audit_markdown": f"""with {AUDIT}, {SIZED}, one as (select * from shared where split = 'all')
select section::int as section, n::bigint as n, line from (
  select * from (values (0, 0, '# Data audit'), (0, 1, ''), (1, 0, 'Dataset: `data`'), (1, 1, ''), (1, 2, '## Overview'), (1, 3, ''), (3, 0, ''), (3, 1, '## Class counts'), (3, 2, ''), (5, 0, ''), (5, 1, '## Split and group counts'), (5, 2, '')) t(section, n, line)
  union all select 1, 4, '- Images: `' || images::varchar || '`' from one union all select 1, 5, '- Objects: `' || objects::varchar || '`' from one union all select 1, 6, '- Background images: `' || background_images::varchar || '`' from one
  union all select 1, 7, '- Background ratio: `' || background_share || '`' from one
  union all select 4, c.class_id, '- `' || class_name || '`: `' || (select count(*) from audited a where a.class_id = c.class_id)::varchar || '`' from (values (0, 'smoke'), (1, 'fire'), (2, 'other')) c(class_id, class_name)
  union all select 6, case split when 'train' then 0 when 'valid' then 100 else 200 end + grp::int, '- `' || split || ' g' || grp || '`: ' || images::varchar || ' images, ' || objects::varchar || ' objects, ' || background_images::varchar || ' background' from shared where split <> 'all' and grp <> 'all')""",
    "data_yaml": f"""with {_NAMES}, b as (select distinct p_brand as name from part), c as (select name, row_number() over (order by name) - 1 as id from b)
select n::bigint as n, line from names union all select id + 5, '  ' || id::varchar || ': "' || name || '"' from c""",
    "class_names_read_back": "with b as (select distinct p_brand as name from part) select cast(row_number() over (order by name) - 1 as int) as class_id, name as class_name from b",
    "annotations_by_prefix": f"""with {COCO}, n as (select image_id, grp from images where image_id % 7 <> 0 and image_id % 11 <> 0)
select g as grp, (select count(*) from n where n.grp = g) as images, (select count(*) from annotations join n using (image_id) where n.grp = g) as annotations from (select unnest(['01', '02', '03', '04', '05', '06']) as g)""",
    "group_subsets": f"with {COCO} select grp, count(*) as images from images where grp <> '03' group by grp",
    "positive_sizes": "select p_partkey as image_id, cast(200+(p_partkey*37)%2000 as int) as width, cast(200+(p_partkey*53)%1500 as int) as height from part where p_partkey % 10 <> 0",
    "pooled_exports": f"with {BUILD} select split as export, grp, count(*) as images, min(image_id) as first_image from sourced group by 1, 2",
    "predictions_per_image": f"with {BOXES} select image_id, count(*)::int as n, string_agg(event_id::varchar, ',' order by score desc, event_id) as event_ids from dets where score >= 0.25 group by image_id",
    "drawn_images": f"""with {BOXES}, b as (select image_id, 1 as p, 0 as t from dets where score >= 0.25 union all select image_id, 0, 1 from truth)
select image_id, sum(p)::bigint as n_predictions, sum(t)::bigint as n_truth from b group by image_id order by image_id limit 20""",
    "eval_ap_by_iou": f"with {AP} select subset, printf('%.2f', 0.5::double + thr_idx * 0.05::double) as iou, ap from ap",
    "eval_summary_rows": f"""with {AP}, maps as (select s.subset, images, gt_objects, detections, max(ap) filter (thr_idx = 0) as map50, round(avg(ap), 8) as map50_95 from sizes s join ap using (subset) group by 1, 2, 3, 4),
hits as (select subset, sum(tp) as t, count(*) as k from subsets where thr_idx = 0 and score >= 0.25 group by 1),
counted as (select m.*, cast(coalesce(t, 0) as bigint) as tp, cast(coalesce(k, 0) as bigint) as k from maps m left join hits using (subset)),
rated as (select *, k - tp as fp, gt_objects - tp as fn, case when k > 0 then tp::double / k::double else 0.0::double end as p, case when gt_objects > 0 then tp::double / gt_objects::double else 'NaN'::double end as r from counted)
select subset, images, gt_objects, detections, map50, map50_95, tp, fp, fn, p as precision_at_conf, r as recall_at_conf, case when isnan(r) then 'NaN'::double when p + r > 0 then 2 * p * r / (p + r) else 0.0::double end as f1_at_conf from rated""",
    "stage_best_table": f"with e as ({_EPOCHS}) {_BEST}",
    "metric_aliases": f"with e as ({_EPOCHS}) select stage, epoch, precision, recall, mAP50, mAP50_95 from e",
    "empty_grid_cells": f"with {ASSIGNED} select split, grp from grid where (split, grp) not in (select (split, grp) from assigned where not (split = 'test' and grp in ('03', '04')))",
}
