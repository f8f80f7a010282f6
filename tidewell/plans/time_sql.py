"""The times of the given tables read in plain SQL, by lists of formats: a second reading of the same rules."""

from __future__ import annotations

# The month names of feeds that are not written in English.
MONTHS = ["januar januari janvier enero", "februar février febrero", "märz mars marzo", "april avril abril", "mai mayo", "juni juin junio", "juli juillet julio", "august août agosto", "september septembre septiembre", "oktober octobre octubre", "november novembre noviembre", "dezember décembre diciembre"]
ENGLISH = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
_MONTH = "MAP {" + ", ".join(f"'{name}': {i}" for i, names in enumerate(MONTHS, 1) for name in sorted({*names.split(), ENGLISH[i - 1]})) + "}"
_STANDARD = "('EST', 'CST', 'MST', 'PST', 'CET', 'MEZ', 'EET', 'WET', 'AEST', 'ACST', 'NZST')"
_HOSTS = r"regexp_replace(regexp_extract(lower({}), '^[a-z]+://(?:[^/@]*@)?([^/:?#]+)', 1), '^(?:www\d?\.|m\.|mobile\.|amp\.)+', '')"
_NAMED = r"'^(\d{1,2})\.?(?: de)? ([^0-9 .,]+)(?: de)? (\d{4}), (\d{1,2}):(\d{2})(?: Uhr)?$'"
_HAN = r"'^(\d{4})年(\d{1,2})月(\d{1,2})日 (上午|下午)(\d{1,2}):(\d{2})$'"

READ = rf"""WITH c AS (SELECT id, {_HOSTS.format("url")} AS host, metadata['timezone'] AS zone, coalesce(metadata['date_order'], 'dmy') AS ord FROM source_config),
h AS (SELECT host, min_by(zone, id) AS zone, min_by(ord, id) AS ord FROM c GROUP BY 1),
v AS (SELECT 'fetched_content.published_at' AS field, content_id AS rec_id, published_at AS raw, source AS s, url FROM fetched_content
  UNION ALL SELECT 'fetched_content.fetched_at', content_id, fetched_at, NULL, NULL FROM fetched_content UNION ALL SELECT 'source_item.published_at', item_id, published_at, source_id, url FROM source_item),
z AS (SELECT field, rec_id, trim(regexp_replace(raw, '\s+', ' ', 'g')) AS v, CASE WHEN field LIKE '%fetched_at' THEN 'UTC' ELSE coalesce(CASE WHEN v.s IS NULL THEN h.zone ELSE c.zone END, 'UTC') END AS zone,
  coalesce(CASE WHEN v.s IS NULL THEN h.ord ELSE c.ord END, 'dmy') AS ord FROM v LEFT JOIN c ON c.id = v.s LEFT JOIN h ON v.s IS NULL AND h.host = {_HOSTS.format("v.url")}),
p AS (SELECT *, regexp_extract(v, ' ?(Z|[+-]\d{{2}}:?\d{{2}}|UTC[+-]\d{{1,2}})( \d{{4}})?$', 1) AS off, regexp_extract(v, ' ([A-Z]{{3,5}})$', 1) AS abbr, regexp_matches(v, '^\d{{4}}-\d\d-\d\d$') AS dated FROM z),
b AS (SELECT *, CASE WHEN off = '' OR dated THEN regexp_replace(v, ' (UTC|GMT|[A-Z]{{3,5}})$', '') ELSE regexp_replace(v, ' ?(Z|[+-]\d{{2}}:?\d{{2}}|UTC[+-]\d{{1,2}})( \d{{4}})?$', '\2') END AS t FROM p),
w AS (SELECT *, CASE WHEN regexp_matches(v, '^\d{{10}}$') THEN make_timestamp(CAST(v AS BIGINT) * 1000000) WHEN regexp_matches(v, '^\d{{13}}$') THEN make_timestamp(CAST(v AS BIGINT) * 1000)
  WHEN regexp_matches(t, {_NAMED}) THEN TRY_CAST(format('{{}}-{{}}-{{}} {{}}:{{}}', regexp_extract(t, {_NAMED}, 3), {_MONTH}[lower(regexp_extract(t, {_NAMED}, 2))], regexp_extract(t, {_NAMED}, 1), regexp_extract(t, {_NAMED}, 4), regexp_extract(t, {_NAMED}, 5)) AS TIMESTAMP)
  WHEN regexp_matches(t, {_HAN}) THEN try_strptime(regexp_replace(t, {_HAN}, '\1-\2-\3 \5:\6 ') || CASE WHEN contains(t, '上午') THEN 'AM' ELSE 'PM' END, '%Y-%m-%d %I:%M %p')
  WHEN regexp_matches(t, '^\d\d/\d\d/\d{{4}}') THEN CASE WHEN ord = 'mdy' THEN try_strptime(t, '%m/%d/%Y %H:%M') ELSE try_strptime(t, '%d/%m/%Y %H:%M') END
  WHEN regexp_matches(t, '^\d\d\.\d\d\.\d{{4}}') THEN CASE WHEN ord = 'mdy' THEN try_strptime(t, '%m.%d.%Y %H:%M') ELSE try_strptime(t, '%d.%m.%Y %H:%M') END
  ELSE try_strptime(regexp_replace(t, '(:\d\d)\.\d+$', '\1'), ['%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M', '%Y-%m-%d', '%Y%m%dT%H%M%S', '%Y%m%d', '%a, %d %b %Y %H:%M:%S', '%a %b %d %H:%M:%S %Y', '%b %d, %Y %I:%M %p', '%Y/%m/%d %H:%M']) END AS wall FROM b),
o AS (SELECT *, regexp_matches(v, '^\d{{10}}$|^\d{{13}}$') OR off = 'Z' OR abbr IN ('UTC', 'GMT') AS absolute, regexp_replace(off, '[^0-9]', '', 'g') AS digits FROM w WHERE wall IS NOT NULL),
u AS (SELECT *, timezone('UTC', timezone(zone, wall)) AS whole FROM o),
k AS (SELECT *, timezone(zone, timezone('UTC', whole - INTERVAL 1 HOUR)) = wall AS earlier, timezone(zone, timezone('UTC', whole + INTERVAL 1 HOUR)) = wall AS later FROM u),
r AS (SELECT field, rec_id, CASE WHEN absolute THEN wall WHEN off <> '' AND NOT dated THEN wall - (CASE WHEN contains(off, '-') THEN -1 ELSE 1 END) * CASE WHEN length(digits) > 2 THEN to_minutes(CAST(substr(digits, 1, 2) AS INT) * 60 + CAST(substr(digits, 3) AS INT)) ELSE to_hours(CAST(digits AS INT)) END
  WHEN abbr IN {_STANDARD} AND later THEN whole + INTERVAL 1 HOUR WHEN (abbr = '' OR abbr NOT IN {_STANDARD}) AND earlier THEN whole - INTERVAL 1 HOUR ELSE whole END AS utc FROM k)
"""
FOUND = READ + "SELECT field, rec_id, strftime(date_trunc('second', utc), '%Y-%m-%dT%H:%M:%SZ') AS utc FROM r"
