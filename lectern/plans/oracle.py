"""DuckDB SQL with the rows of each query, over views of the same tables."""

from __future__ import annotations

#: All characters that Unicode counts as white space.
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
TALKS = "talks AS (SELECT doc_id, lang, n_chars, n_chars / 16.0::DOUBLE AS duration_s FROM documents)"
MICROS = "epoch_us({0})"


def time_of(ms: str) -> str:
    return f"printf('%02d:%02d:%02d,%03d', ({ms}) // 3600000, ({ms}) // 60000 % 60, ({ms}) // 1000 % 60, ({ms}) % 1000)"


CUES = f"""
timed AS (
  SELECT conv_id, turn, text, row_number() OVER w AS number,
         sum(length(text)) OVER w / 16.0::DOUBLE AS end_s, (sum(length(text)) OVER w - length(text)) / 16.0::DOUBLE AS start_s
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)),
times AS (
  SELECT conv_id, number, trim(regexp_replace(text, '{SPACE}', ' ', 'g'), ' ') AS content,
         greatest(0, round_even(start_s * 1000, 0)::BIGINT) AS a, greatest(0, round_even(end_s * 1000, 0)::BIGINT) AS b FROM timed),
cues AS (
  SELECT conv_id, number::BIGINT AS number, {time_of("a")} AS start_time, {time_of("b")} AS end_time, content, a, b FROM times WHERE content <> '')
"""


def document(number: str, where: str = "") -> str:
    block = f"{number}::VARCHAR || chr(10) || start_time || ' --> ' || end_time || chr(10) || content || chr(10)"
    return f"SELECT conv_id, regexp_replace(string_agg({block}, chr(10) ORDER BY {number}), '\\n+$', '') || chr(10) AS srt, count(*) AS n_cues"


def notches(base: str) -> str:
    return f"list_transform(list_filter(range(1, 11), lambda h: {base} * h <= 900), lambda h: 'bandreject=f=' || ({base} * h)::VARCHAR || ':w=' || (h + 7)::VARCHAR)"


def resampled(new: int, n: int = 64, source: str = "waves") -> str:
    m = max(1, round(n * new / 48000))
    x = f"greatest((i + 0.5::DOUBLE) * ({n}::DOUBLE / {m}::DOUBLE) - 0.5::DOUBLE, 0.0::DOUBLE)"
    return f"""SELECT vec_id, {new} AS rate, i::INT AS pos,
       x[lo + 1] * (1.0::DOUBLE - (p - lo)) + x[least(lo + 1, {n - 1}) + 1] * (p - lo) AS v
FROM (SELECT *, least(floor(p)::INT, {n - 1}) AS lo FROM (SELECT vec_id, x, i, {x} AS p FROM {source}, range(0, {m}) t(i)))"""


def one_decimal(x: str) -> str:
    return f"(round_even({x} * 10, 0)::BIGINT // 10) || '.' || (round_even({x} * 10, 0)::BIGINT % 10)"


WAVES = "waves AS (SELECT vec_id, label, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings)"
#: Four vectors after one another as one signal.
SIGNALS = "signals AS (SELECT vec_id // 4 AS talk, flatten(list(list_transform(embedding, lambda v: v::DOUBLE) ORDER BY vec_id)) AS x, sum(len(embedding))::BIGINT AS n FROM embeddings GROUP BY 1)"
STEM = r"regexp_replace(regexp_extract(url, '([^/?#]*)/?(?:[?#].*)?$', 1), '^(.+)\.[^.]*$', '\1')"
CHUNK = "printf('chunk_%04d.wav', {0})"

def sections(rows: str, rate: float) -> str:
    """CTE sec(talk, k, b0, b1, b2, a1, a2) of second-order filters, from rows (talk, kind, f, q, place)."""
    w = f"2 * pi() * f / {rate}::DOUBLE"
    return f"""raw AS ({rows}),
pre AS (SELECT talk, (row_number() OVER (PARTITION BY talk ORDER BY place, f) - 1) AS k, kind, cos({w}) AS c, sin({w}) / (2 * q) AS al FROM raw),
sec AS (SELECT talk, k, CASE kind WHEN 'n' THEN 1 WHEN 'h' THEN (1 + c) / 2 ELSE (1 - c) / 2 END / (1 + al) AS b0, CASE kind WHEN 'n' THEN -2 * c WHEN 'h' THEN -(1 + c) ELSE 1 - c END / (1 + al) AS b1,
  CASE kind WHEN 'n' THEN 1 WHEN 'h' THEN (1 + c) / 2 ELSE (1 - c) / 2 END / (1 + al) AS b2, -2 * c / (1 + al) AS a1, (1 - al) / (1 + al) AS a2 FROM pre)"""


def sinc(source: str, old: int, new: int, crossings: int) -> str:
    """(talk, pos, v): x of source (talk, x) at new / old of its rate, by a sinc in a Hann window; both rates without a common divisor."""
    band, halo = min(old, new) * 0.99, crossings + 2
    t = f"((k / {old}::DOUBLE - m / {new}::DOUBLE) * {band!r}::DOUBLE)"
    return f"""SELECT talk, m AS pos, sum(x[k + 1] * CASE WHEN {t} = 0 THEN 1 ELSE sin(pi() * {t}) / (pi() * {t}) END * cos({t} * pi() / {crossings}::DOUBLE / 2) ** 2) * {band / old!r}::DOUBLE AS v
FROM (SELECT talk, x, unnest(range(0, (len(x) * {new} + {old - 1}) // {old})) AS m FROM {source}) a, LATERAL (SELECT unnest(range(greatest(0, (m * {old} // {new}) - {-(-halo * old // min(old, new))}), least(len(x), (m * {old} // {new}) + {-(-halo * old // min(old, new))}))) AS k) b
WHERE abs({t}) < {crossings} GROUP BY talk, m"""


#: x through sections, each by its plain recurrence.
RUN = """run AS (SELECT talk, 0::BIGINT AS k, x FROM signals UNION ALL
  SELECT run.talk, run.k + 1, list_reduce(x, lambda s, v: {'l': list_append(s.l, b0 * v + s.p), 'p': b1 * v - a1 * (b0 * v + s.p) + s.q, 'q': b2 * v - a2 * (b0 * v + s.p)}, {'l': []::DOUBLE[], 'p': 0.0::DOUBLE, 'q': 0.0::DOUBLE}).l
  FROM run JOIN sec ON sec.talk = run.talk AND sec.k = run.k),
done AS (SELECT talk, arg_max(x, k) AS y FROM run GROUP BY talk)"""

SQL: dict[str, str] = {
    "q01_discover_talks": f"""SELECT page_id, s AS stem, s || '_enhanced.wav' AS audio, s || '_es.srt' AS srt_es, s || '_en.srt' AS srt_en, s || '_final.mkv' AS video,
       {CHUNK.format("page_id")} AS chunk_name FROM (SELECT page_id, {STEM} AS s FROM pages WHERE contains(url, '.example.com/'))""",
    "q02_probe_duration": f"""WITH {TALKS} SELECT doc_id, duration_s, floor(duration_s)::BIGINT AS whole_s, floor(duration_s)::BIGINT // 3600 AS hours,
       floor(duration_s)::BIGINT % 3600 // 60 AS minutes FROM talks""",
    "q03_segment_fixed": """SELECT chunk_s, us - us % (chunk_s::BIGINT * 1000000) AS chunk_start_us, count(*) AS n,
       min(us % (chunk_s::BIGINT * 1000000)) AS first_offset_us, max(us % (chunk_s::BIGINT * 1000000)) AS last_offset_us
FROM (SELECT epoch_us(ts) AS us, unnest([300, 900])::INT AS chunk_s FROM events) GROUP BY 1, 2""",
    "q04_chunk_progress": f"""WITH {TALKS}, c AS (SELECT lang, (floor(duration_s)::BIGINT + 899) // 900 AS expected, doc_id IN (SELECT doc_id FROM labels) AS is_done FROM talks)
SELECT lang, sum(expected)::BIGINT AS total, sum(CASE WHEN is_done THEN expected ELSE 0 END)::BIGINT AS done,
       (sum(expected) - sum(CASE WHEN is_done THEN expected ELSE 0 END))::BIGINT AS remaining,
       sum(CASE WHEN is_done THEN expected ELSE 0 END) >= sum(expected) AS complete FROM c GROUP BY lang""",
    "q05_skip_policies": """SELECT doc_id, n_chars, n_chars IS NOT NULL AS exists, coalesce(n_chars > 0, false) AS non_empty, coalesce(n_chars > 1000, false) AS over_1000,
       coalesce(n_chars > 10000, false) AS over_10000, coalesce(n_chars > 1024, false) AS over_1k_block FROM documents""",
    "q06_pending_chunks": f"WITH {TALKS} SELECT doc_id, lang, ceil(duration_s / 900)::BIGINT AS n_chunks FROM talks WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)",
    "q07_ordered_concat": f"""SELECT conv_id, string_agg('file ''' || {CHUNK.format("turn")} || '''', chr(10) ORDER BY turn) AS manifest, count(*) AS n_chunks,
       md5(string_agg(text, '' ORDER BY turn)) AS whole_md5, length(string_agg(text, '' ORDER BY turn)) AS whole_chars FROM conversations GROUP BY conv_id""",
    "q08_mux_two": """WITH u AS (SELECT conv_id, arg_min(length(text), turn) / 16.0::DOUBLE AS user_s FROM conversations WHERE role = 'user' GROUP BY 1),
a AS (SELECT conv_id, arg_min(length(text), turn) / 16.0::DOUBLE AS assistant_s FROM conversations WHERE role = 'assistant' GROUP BY 1)
SELECT conv_id, user_s, assistant_s, least(user_s, assistant_s) AS duration_s, greatest(user_s, assistant_s) AS longest_s FROM u JOIN a USING (conv_id)""",
    "q09_mux_four": """WITH t AS (SELECT conv_id, (max(turn) - min(turn) + 1) * 30.0::DOUBLE AS video_s, sum(length(text)) / 16.0::DOUBLE AS audio_s,
  sum(length(text)) FILTER (role = 'user') / 16.0::DOUBLE AS es_s, sum(length(text)) FILTER (role = 'assistant') / 16.0::DOUBLE AS en_s FROM conversations GROUP BY 1)
SELECT *, least(video_s, audio_s, es_s, en_s) AS duration_s FROM t WHERE es_s IS NOT NULL AND en_s IS NOT NULL""",
    "q10_srt_document": f"WITH {CUES} {document('number')} FROM cues GROUP BY conv_id",
    "q11_srt_cues": f"WITH {CUES} SELECT conv_id, number, start_time, end_time, content FROM cues",
    "q12_srt_translate_roundtrip": f"""WITH {CUES}, dense AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY a, b, number) AS k FROM cues WHERE b > a)
{document("k")} FROM dense GROUP BY conv_id""",
    "q13_language_route": """WITH r AS (SELECT 'document' AS kind, doc_id AS id, lang AS language FROM documents UNION ALL
  SELECT 'page', page_id, regexp_extract(html, '<html lang="([^"]+)"', 1) FROM pages),
l AS (SELECT kind, id, coalesce(nullif(language, ''), 'unknown') AS language FROM r)
SELECT *, CASE language WHEN 'en' THEN 'copy_source' ELSE 'asr_translate' END AS en_route,
       CASE language WHEN 'es' THEN 'copy_source' WHEN 'en' THEN 'translate_source' ELSE 'translate_english' END AS es_route FROM l""",
    "q14_package_lookup": """WITH p(lang, to_code, package, rank) AS (VALUES ('en', 'es', 'en_es_1', 1), ('en', 'es', 'en_es_2', 2), ('fr', 'en', 'fr_en_1', 3), ('de', 'en', 'de_en_1', 4)),
f AS (SELECT lang, to_code, arg_min(package, rank) AS package FROM p GROUP BY 1, 2),
d AS (SELECT doc_id, lang, CASE WHEN lang = 'en' THEN 'es' ELSE 'en' END AS to_code FROM documents)
SELECT doc_id, lang, to_code, package, package IS NULL AS fatal FROM d LEFT JOIN f USING (lang, to_code)""",
    "q15_batch_summary": """SELECT user_id, count(*) AS n_items, count(*) FILTER (event_type = 'error') AS n_failed, count(*) FILTER (event_type <> 'error') AS n_ok,
       (count(*) FILTER (event_type = 'error') > 0)::INT AS exit_status FROM events GROUP BY user_id""",
    "q15b_batch_json": """SELECT event_id, '{"event_id":' || event_id || ',"status":"' || CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END || '","batch":' || user_id || '}' AS json FROM events""",
    "q16_regen_decisions": """WITH f AS (SELECT doc_id, quality = 1 AS have, toxic = 0 AS asr, unnest(range(0, 8))::INT AS flags FROM labels)
SELECT doc_id, flags, flags % 2 = 1 OR NOT have AS make_audio, flags % 2 = 1 OR flags // 2 % 2 = 1 OR NOT asr AS make_asr_audio, NOT have AS transcribe, flags // 4 = 1 OR true AS remux FROM f""",
    "q17_filter_chain": f"""WITH e AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'none' WHEN 'signup' THEN 'gentle' WHEN 'error' THEN 'electronic' ELSE 'hum' END AS profile,
  CASE WHEN user_id % 2 = 0 THEN 60 ELSE 50 END AS base FROM events)
SELECT event_id, profile, base, CASE WHEN event_id % 50 = 0 THEN 'highpass=f=100' WHEN profile = 'none' THEN 'anull' WHEN profile = 'gentle' THEN 'highpass=f=70,lowpass=f=12000,afftdn=nr=5:nf=-40'
  ELSE array_to_string(list_concat(['highpass=f=75', 'lowpass=f=12000'], {notches("base")},
       CASE WHEN event_id % 3 = 0 THEN {notches("(CASE WHEN base = 60 THEN 50 ELSE 60 END)")} ELSE [] END, ['afftdn=nr=6:nf=-35']), ',') END AS chain FROM e""",
    "q18_container_path": r"""WITH p AS (SELECT page_id, CASE WHEN page_id % 10 = 0 THEN '/srv/talks' ELSE '/srv/talks/' || regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1) END AS path FROM pages)
SELECT page_id, path, CASE WHEN path = '/srv/talks' THEN '/workspace' ELSE '/workspace/' || substr(path, 12) END AS container FROM p""",
    "q19_clamp_and_shape": f"""WITH {WAVES}, c AS (SELECT vec_id, list_transform(x, lambda v: greatest(-1.0::DOUBLE, least(1.0::DOUBLE, v * 4))) AS x FROM waves)
SELECT vec_id, i::INT AS pos, x[i + 1] AS left, x[i + 33] AS right, 2 AS n_channels, round_even(x[i + 1] * 32767.0::DOUBLE, 0)::INT AS left_pcm FROM c, range(0, 32) t(i)""",
    "q20_downmix": f"WITH {WAVES} SELECT vec_id, i::INT AS pos, (x[i + 1] + x[i + 33]) / 2 AS mono, x[i + 1] AS first FROM waves, range(0, 32) t(i)",
    "q20b_audio_metadata": "SELECT vec_id, 48000 AS sample_rate, (len(embedding) // 2)::INT AS num_frames, 2 AS num_channels, 0 AS bits_per_sample, 'UNKNOWN' AS encoding FROM embeddings",
    "q21_resample_linear": f"WITH {WAVES} {resampled(16000)} UNION ALL {resampled(96000)}",
    "q22_level_normalise": f"""WITH {WAVES}, l AS (SELECT vec_id, sqrt(list_reduce(list_transform(x, lambda v: v * v), lambda a, b: a + b) / len(x)) AS rms, list_max(list_transform(x, lambda v: abs(v))) AS peak FROM waves)
SELECT vec_id, rms, peak, 0.5::DOUBLE / peak AS peak_gain, 0.1::DOUBLE / rms AS rms_gain FROM l""",
    "q23_progress_eta": """WITH r AS (SELECT event_id, user_id, row_number() OVER w AS done, count(*) OVER (PARTITION BY user_id) AS total, (sum(value::DECIMAL(18,2)) OVER w)::DOUBLE AS elapsed_s
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT *, elapsed_s / done AS mean_s, elapsed_s / done * (total - done) AS eta_s FROM r""",
    "q24_crossfade_concat": f"""WITH {SIGNALS}, d AS (SELECT *, n / 16.0::DOUBLE AS duration FROM signals),
c AS (SELECT talk, x, idx::INT AS idx, greatest(0, idx * 5 - CASE WHEN idx > 0 THEN 2 ELSE 0 END) AS start, duration FROM d, range(0, 1000) r(idx) WHERE idx < ceil(duration / 5)),
s AS (SELECT talk, x, idx, start, (least(5.0::DOUBLE + CASE WHEN idx > 0 THEN 2 ELSE 0 END, duration - start) * 16)::BIGINT AS size FROM c),
f AS (SELECT *, least(32, size, coalesce(max(size) OVER (PARTITION BY talk ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS n FROM s),
a AS (SELECT *, coalesce(sum(size - n) OVER (PARTITION BY talk ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT - n AS at_ FROM f),
v AS (SELECT talk, idx, at_ + p AS pos, x[start * 16 + p + 1] * (1.0::DOUBLE + idx / 4.0::DOUBLE) AS v, CASE WHEN p < n THEN CASE WHEN n > 1 THEN p / (n - 1)::DOUBLE ELSE 0.0::DOUBLE END END AS share FROM a, range(0, 1000) r(p) WHERE p < size),
l AS (SELECT talk, pos, list({{'v': v, 'share': share}} ORDER BY idx) AS parts FROM v GROUP BY 1, 2)
SELECT talk, pos, list_reduce(list_prepend(0.0::DOUBLE, range(0, len(parts))::DOUBLE[]), lambda acc, k: CASE WHEN parts[k::INT + 1].share IS NULL THEN parts[k::INT + 1].v ELSE acc * (1.0::DOUBLE - parts[k::INT + 1].share) + parts[k::INT + 1].v * parts[k::INT + 1].share END) AS v FROM l""",
    "q25_segment_truncated": f"""WITH {TALKS}, c AS (SELECT doc_id, duration_s, unnest(range(0, ceil(duration_s / 300)::BIGINT))::INT AS idx FROM talks)
SELECT doc_id, idx, (idx * 300)::DOUBLE AS start, least(300.0::DOUBLE, duration_s - idx * 300) AS length FROM c""",
    "q26_segment_overlap": f"""WITH {TALKS}, c AS (SELECT doc_id, duration_s, unnest(range(0, ceil(duration_s / 300)::BIGINT))::INT AS idx FROM talks),
s AS (SELECT *, greatest(0.0::DOUBLE, idx * 300.0::DOUBLE - CASE WHEN idx > 0 THEN 2.0::DOUBLE ELSE 0 END) AS start FROM c)
SELECT doc_id, idx, start, least(CASE WHEN idx > 0 THEN 302.0::DOUBLE ELSE 300.0::DOUBLE END, duration_s - start) AS length, idx > 0 AS has_overlap_start, {CHUNK.format("idx")} AS name FROM s""",
    "q27_slot_dispatch": """WITH r AS (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) AS place FROM orders)
SELECT o_orderkey, place, CASE WHEN place <= 3 THEN 0 WHEN place <= 4 THEN 1 END::INT AS device, CASE WHEN place <= 4 THEN 'running' ELSE 'waiting' END AS state FROM r""",
    "q28_mini_batches": """WITH p AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL))
SELECT doc_id, lang, place, place // 200 AS batch_id FROM p""",
    "q29_prefix_limit": """SELECT event_id, user_id FROM (SELECT *, min(ts) OVER (PARTITION BY user_id) AS first_ts FROM events) WHERE epoch_us(ts) - epoch_us(first_ts) < 300000000""",
    "q30_external_transform": f"""WITH {WAVES} SELECT vec_id, CASE WHEN label = 9 THEN 'error' ELSE 'ok' END AS status, CASE WHEN label = 9 THEN 'label 9' ELSE '' END AS error,
       i::INT AS pos, CASE WHEN label = 9 THEN x[i + 1] ELSE x[i + 1] / 2 END AS v FROM waves, range(0, 64) t(i)""",
    "q21b_asr_audio": f"""WITH {WAVES}, mono AS (SELECT vec_id, list_transform(range(1, 33), lambda i: (x[i] + x[i + 32]) / 2) AS x FROM waves) {resampled(16000, 32, "mono")}""",
    "q22b_normalised_samples": f"""WITH {WAVES}, l AS (SELECT vec_id, x, 0.5::DOUBLE / list_max(list_transform(x, lambda v: abs(v))) AS gain FROM waves)
SELECT vec_id, i::INT AS pos, greatest(-1.0::DOUBLE, least(1.0::DOUBLE, x[i + 1] * gain)) AS v FROM l, range(0, 64) t(i)""",
    "q31_video_probe": """WITH e AS (SELECT event_id, (props->>'$.k')::INT AS k, CASE WHEN event_id % 7 = 0 THEN '0/0' WHEN event_id % 3 = 0 THEN '30000/1001' WHEN event_id % 3 = 1 THEN '25/1' ELSE user_id::VARCHAR END AS r FROM events)
SELECT event_id, k * 16 AS width, k * 9 AS height, r AS r_frame_rate,
       CASE WHEN contains(r, '/') THEN split_part(r, '/', 1)::DOUBLE / nullif(split_part(r, '/', 2)::DOUBLE, 0) ELSE r::DOUBLE END AS fps FROM e""",
    "q32_chunk_set_skip": """WITH t AS (SELECT conv_id, count(*) FILTER (length(text) > 300) AS n_present, (max(turn) + 1)::BIGINT AS n_expected FROM conversations GROUP BY 1)
SELECT *, n_present > 0 AS skip_split, n_present >= n_expected AS complete, n_present > 0 AND n_present < n_expected AS partial FROM t""",
    "q33_summary_document": """SELECT conv_id, '[' || chr(10) || string_agg('  {' || chr(10) || '    "turn": ' || turn || ',' || chr(10) || '    "role": "' || role || '",' || chr(10) || '    "chars": ' || length(text) || ',' || chr(10)
       || '    "ok": ' || (length(text) > 300)::VARCHAR || chr(10) || '  }', ',' || chr(10) ORDER BY turn) || chr(10) || ']' AS json, count(*) AS n_items FROM conversations GROUP BY 1""",
    "q34_wav_round_trip": f"""WITH {WAVES} SELECT vec_id, c::INT AS channel, 48000 AS sample_rate, i::INT AS pos,
       (round_even(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, x[c * 32 + i + 5] * 4)) * 32767.0::DOUBLE, 0)::FLOAT / 32768::FLOAT)::DOUBLE AS v FROM waves, range(0, 2) a(c), range(0, 20) b(i)""",
    "q35_final_streams": """WITH t AS (SELECT conv_id, (max(turn) - min(turn) + 1) * 30.0::DOUBLE AS video_s, sum(length(text)) / 16.0::DOUBLE AS audio_s,
  sum(length(text)) FILTER (role = 'user') / 16.0::DOUBLE AS es_s, sum(length(text)) FILTER (role = 'assistant') / 16.0::DOUBLE AS en_s FROM conversations GROUP BY 1),
m AS (SELECT *, least(video_s, audio_s, es_s, en_s) AS duration_s FROM t WHERE es_s IS NOT NULL AND en_s IS NOT NULL)
SELECT conv_id, 0 AS stream, 'video' AS kind, NULL::VARCHAR AS language, NULL::VARCHAR AS title, video_s AS source_s, duration_s FROM m
UNION ALL SELECT conv_id, 1, 'audio', NULL, NULL, audio_s, duration_s FROM m
UNION ALL SELECT conv_id, 2, 'subtitle', 'spa', 'Español', es_s, duration_s FROM m
UNION ALL SELECT conv_id, 3, 'subtitle', 'eng', 'English', en_s, duration_s FROM m""",
    "q36_done_table": "SELECT doc_id, n_chars FROM documents WHERE NOT ((doc_id % 2 = 0 OR doc_id % 3 = 0) AND n_chars > 1000)",
    "q37_report_texts": f"WITH {TALKS} SELECT doc_id, {one_decimal('(duration_s / 60)')} || ' min' AS minutes, {one_decimal('(n_chars * 1048576.0::DOUBLE / 1073741824.0::DOUBLE)')} || ' GB' AS size FROM talks",
    "q39_filtered_samples": f"""WITH RECURSIVE {WAVES}, {SIGNALS}, {sections("""SELECT talk, 'h' AS kind, CASE talk % 3 WHEN 1 THEN 70.0 ELSE 75.0 END::DOUBLE AS f, 0.707::DOUBLE AS q, 0 AS place FROM signals WHERE talk % 3 > 0
UNION ALL SELECT talk, 'l', 12000, 0.707, 1 FROM signals WHERE talk % 3 > 0 UNION ALL SELECT talk, 'n', 50 * h, 7 + h, 2 FROM signals, range(1, 11) r(h) WHERE talk % 3 = 2
UNION ALL SELECT talk, 'n', 60 * h, 7 + h, 3 FROM signals, range(1, 11) r(h) WHERE talk % 3 = 2 AND talk % 2 = 0""", 48000)}, {RUN}
SELECT talk, i AS pos, round_even(y[i + 1] * 1e6::DOUBLE, 0)::BIGINT AS micro FROM done, range(0, 256) r(i) WHERE i < len(y)""",
    "q40_resample_sinc": f"""WITH {SIGNALS} SELECT talk, 16000 AS rate, pos, round_even(v * 1e6::DOUBLE, 0)::BIGINT AS micro FROM ({sinc("signals", 3, 1, 16)})
UNION ALL SELECT talk, 64000, pos, round_even(v * 1e6::DOUBLE, 0)::BIGINT FROM ({sinc("signals", 3, 4, 64)})""",
    "q41_loudness": f"""WITH RECURSIVE signals AS (SELECT vec_id // 100 AS talk, flatten(list(list_transform(embedding, lambda v: v::DOUBLE * [1.0::DOUBLE, 0.3::DOUBLE, 0.02::DOUBLE, 0.00005::DOUBLE][vec_id // 16 % 4 + 1]) ORDER BY vec_id)) AS x FROM embeddings GROUP BY 1),
k1 AS (SELECT tan(pi() * 1681.974450955533::DOUBLE / 4000) AS k, 10 ** (3.999843853973347::DOUBLE / 20) AS v, 0.7071752369554196::DOUBLE AS q), k2 AS (SELECT tan(pi() * 38.13547087602444::DOUBLE / 4000) AS k, 0.5003270373238773::DOUBLE AS q),
sec AS (SELECT talk, 0 AS k, (v + u * k / q + k * k) / z AS b0, 2 * (k * k - v) / z AS b1, (v - u * k / q + k * k) / z AS b2, 2 * (k * k - 1) / z AS a1, (1 - k / q + k * k) / z AS a2 FROM signals, (SELECT *, v ** 0.4996667741545416::DOUBLE AS u, 1 + k / q + k * k AS z FROM k1)
  UNION ALL SELECT talk, 1, 1, -2, 1, 2 * (k * k - 1) / (1 + k / q + k * k), (1 - k / q + k * k) / (1 + k / q + k * k) FROM signals, k2), {RUN},
s AS (SELECT talk, unnest(range(0, len(y))) AS i, unnest(y) AS v FROM done), t AS (SELECT talk, i // 400 AS slot, sum(v * v) AS e, count(*) AS n FROM s GROUP BY 1, 2),
b AS (SELECT talk, w, slot AS block, (sum(e) OVER f) / (400 * w) AS p, (sum(n) OVER f) AS n FROM (SELECT t.*, 4 AS w FROM t) WINDOW f AS (PARTITION BY talk ORDER BY slot ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)
  UNION ALL SELECT talk, w, slot, (sum(e) OVER f) / (400 * w), (sum(n) OVER f) FROM (SELECT t.*, 6 AS w FROM t) WINDOW f AS (PARTITION BY talk ORDER BY slot ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING)),
o AS (SELECT *, -0.691::DOUBLE + 10 * log10(p) AS l FROM b WHERE n = 400 * w AND p > 0), g AS (SELECT talk, w, -0.691::DOUBLE + 10 * log10(avg(p)) - CASE w WHEN 4 THEN 10 ELSE 20 END AS gate FROM o WHERE l > -70 GROUP BY 1, 2),
a AS (SELECT o.* FROM o JOIN g USING (talk, w) WHERE l > -70 AND l > gate),
m AS (SELECT talk, -0.691::DOUBLE + 10 * log10(avg(p) FILTER (w = 4)) AS integrated, quantile_cont(round_even(l * 100, 0) / 100, 0.95) FILTER (w = 6) - quantile_cont(round_even(l * 100, 0) / 100, 0.1) FILTER (w = 6) AS range FROM a GROUP BY 1),
p AS (SELECT talk, 20 * log10(max(abs(v))) AS true_peak FROM ({sinc("signals", 1, 4, 16)}) GROUP BY 1)
SELECT talk, round_even(integrated * 1e6::DOUBLE, 0)::BIGINT AS integrated, round_even(range * 1e6::DOUBLE, 0)::BIGINT AS range, round_even(true_peak * 1e6::DOUBLE, 0)::BIGINT AS true_peak,
  round_even(CASE WHEN integrated IS NULL OR true_peak IS NULL THEN 1 ELSE 10 ** (least(-24 - integrated, -3 - true_peak) / 20) END * 1e6::DOUBLE, 0)::BIGINT AS gain FROM p LEFT JOIN m USING (talk)""",
    "q42_keyframe_chunks": """WITH e AS (SELECT user_id, event_id, epoch_us(ts) // 1000000 AS s FROM events), u AS (SELECT user_id, min(s) AS f, max(s) - min(s) + 1 AS duration FROM e GROUP BY 1),
t AS (SELECT user_id, duration, unnest(range(86400, duration, 86400)) AS at_ FROM u), k AS (SELECT DISTINCT user_id, s - f AS at_ FROM e JOIN u USING (user_id) WHERE event_id % 3 = 0),
c AS (SELECT DISTINCT t.user_id, t.duration, k.at_ AS start FROM t ASOF JOIN k ON t.user_id = k.user_id AND t.at_ <= k.at_ WHERE k.at_ < t.duration UNION SELECT user_id, duration, 0 FROM u)
SELECT user_id, row_number() OVER w - 1 AS idx, start, coalesce(lead(start) OVER w, duration) AS stop FROM c WINDOW w AS (PARTITION BY user_id ORDER BY start)""",
    "q43_limited_samples": f"""WITH {SIGNALS}, p AS (SELECT talk, i, CASE WHEN i BETWEEN 0 AND n - 1 THEN x[i + 1] * 4 END AS v FROM signals, range(-12, 300) r(i) WHERE i < n + 12),
g AS (SELECT *, CASE WHEN abs(v) > 0.95 THEN 0.95::DOUBLE / abs(v) ELSE 1.0::DOUBLE END AS need FROM p),
l AS (SELECT *, min(need) OVER (PARTITION BY talk ORDER BY i ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS least_ FROM g),
m AS (SELECT *, avg(least_) OVER (PARTITION BY talk ORDER BY i ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS gain FROM l)
SELECT talk, i AS pos, round_even(v * gain * 1e6::DOUBLE, 0)::BIGINT AS micro FROM m WHERE v IS NOT NULL""",
    "q44_speech_segments": f"""WITH {WAVES}, s AS (SELECT vec_id // 100 AS talk, vec_id % 100 * 64 + i AS pos, round_even(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, x[i + 1] * [1.0::DOUBLE, 0.3::DOUBLE, 0.02::DOUBLE, 0.00005::DOUBLE][vec_id // 16 % 4 + 1])) * 32767.0::DOUBLE, 0)::BIGINT AS v FROM waves, range(0, 64) r(i)),
f AS (SELECT talk, pos // 80 AS frame, sum(v * v)::BIGINT AS e, count(*) AS n FROM s GROUP BY 1, 2),
h AS (SELECT *, CASE WHEN e >= 2000000 * n THEN 1 WHEN e < 20000 * n THEN 0 END AS ev FROM f),
o AS (SELECT *, coalesce(last_value(ev IGNORE NULLS) OVER (PARTITION BY talk ORDER BY frame), 0) AS on_ FROM h),
g AS (SELECT *, frame - lag(frame) OVER (PARTITION BY talk ORDER BY frame) - 1 AS gap FROM o WHERE on_ = 1),
r AS (SELECT *, sum(CASE WHEN gap > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY talk ORDER BY frame) AS run FROM g)
SELECT talk, min(frame) AS first, max(frame) AS last, sum(e)::BIGINT AS energy FROM r GROUP BY talk, run HAVING max(frame) - min(frame) + 1 >= 4""",
    "q45_denoised_samples": f"""WITH {SIGNALS}, w AS (SELECT list(sin(pi() * (j + 0.5::DOUBLE) / 16) ORDER BY j) AS w FROM range(0, 16) r(j)),
c AS (SELECT *, 10 ** (-12.0::DOUBLE / 10) * (list_sum(w) / 2) ** 2 AS noise, 10 ** (-6.0::DOUBLE / 20) AS least_ FROM w),
v AS (SELECT talk, f, j, CASE WHEN f * 4 + j BETWEEN 0 AND s.n - 1 THEN x[f * 4 + j + 1] ELSE 0 END * w[j + 1] AS v FROM signals s, c, range(-3, 64) a(f), range(0, 16) b(j) WHERE f * 4 < s.n),
d AS (SELECT talk, f, k, sum(v * cos(2 * pi() * k * j / 16)) AS re, -sum(v * sin(2 * pi() * k * j / 16)) AS im FROM v, range(0, 9) r(k) GROUP BY 1, 2, 3),
g AS (SELECT talk, f, k, re, im, CASE WHEN k IN (0, 8) THEN 1 ELSE 2 END * greatest(sqrt(greatest(0, 1 - noise / greatest(re * re + im * im, 1e-300))), least_) AS g FROM d, c),
y AS (SELECT talk, f * 4 + j AS pos, sum(g * (re * cos(2 * pi() * k * j / 16) - im * sin(2 * pi() * k * j / 16))) / 16 * any_value(w[j + 1]) AS y FROM g, c, range(0, 16) r(j) GROUP BY talk, f, j)
SELECT talk, pos, round_even(sum(y) / any_value(w[pos % 4 + 1] ** 2 + w[pos % 4 + 5] ** 2 + w[pos % 4 + 9] ** 2 + w[pos % 4 + 13] ** 2) * 1e6::DOUBLE, 0)::BIGINT AS micro FROM y JOIN signals USING (talk), c WHERE pos BETWEEN 0 AND n - 1 GROUP BY talk, pos""",
    "q46_wav_ranges": f"""WITH {WAVES}, s AS (SELECT vec_id // 40 AS talk, c::INT AS channel, vec_id % 40 * 32 + i AS frame, x[c * 32 + i + 1] AS v FROM waves, range(0, 2) a(c), range(0, 32) b(i))
SELECT talk, 48000 AS sample_rate, channel, frame - 100 AS pos, (round_even(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, v * 4)) * 32767.0::DOUBLE, 0)::FLOAT / 32768::FLOAT)::DOUBLE AS v FROM s WHERE frame >= 100 AND frame < 1000""",
    "q47_translated_texts": f"""WITH t AS (SELECT conv_id, turn::INT AS turn, text AS content FROM conversations UNION ALL SELECT doc_id, -1, concat_ws(chr(10), lang, source) FROM documents)
SELECT conv_id, turn, trim(translate(content, 'aeiou', 'uoiea'), chr(10) || ' ') AS content FROM t""",
    "q48_fatal_checks": """WITH c AS (SELECT doc_id, count(*) AS n FROM labels GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_chunks, CASE WHEN n IS NULL THEN 'no chunks' WHEN lang IN ('en', 'es', 'de') THEN NULL ELSE 'invalid mode: ' || coalesce(lang, 'null') END AS fatal FROM documents LEFT JOIN c USING (doc_id)""",
    "q49_chain_samples": f"""WITH RECURSIVE {SIGNALS.replace("signals AS", "plain AS")}, signals AS (SELECT talk, list_transform(x, lambda v: v * 4) AS x FROM plain),
{sections("SELECT talk, 'h' AS kind, 70.0::DOUBLE AS f, 0.707::DOUBLE AS q, 0 AS place FROM signals UNION ALL SELECT talk, 'l', 300, 0.707, 1 FROM signals", 1000)}, {RUN},
p AS (SELECT talk, i, CASE WHEN i BETWEEN 0 AND len(y) - 1 THEN y[i + 1] END AS v FROM done, range(-10, 300) r(i) WHERE i < len(y) + 10),
g AS (SELECT *, CASE WHEN abs(v) > 0.5 THEN 0.5::DOUBLE / abs(v) ELSE 1.0::DOUBLE END AS need FROM p),
l AS (SELECT *, min(need) OVER (PARTITION BY talk ORDER BY i ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS least_ FROM g),
m AS (SELECT *, avg(least_) OVER (PARTITION BY talk ORDER BY i ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS gain FROM l),
x2 AS (SELECT talk, list(v * gain ORDER BY i) AS x FROM m WHERE v IS NOT NULL GROUP BY 1), c AS (SELECT cos(2 * pi() * 50 / 1000::DOUBLE) AS c, sin(2 * pi() * 50 / 1000::DOUBLE) / 16 AS al),
z AS (SELECT talk, list_reduce(x, lambda s, v: {{'l': list_append(s.l, v / (1 + al) + s.p), 'p': -2 * c / (1 + al) * v + 2 * c / (1 + al) * (v / (1 + al) + s.p) + s.q, 'q': v / (1 + al) - (1 - al) / (1 + al) * (v / (1 + al) + s.p)}}, {{'l': []::DOUBLE[], 'p': 0.0::DOUBLE, 'q': 0.0::DOUBLE}}).l AS y FROM x2, c)
SELECT talk, i AS pos, round_even(y[i + 1] * 1e6::DOUBLE, 0)::BIGINT AS micro FROM z, range(0, 256) r(i) WHERE i < len(y)""",
    "q50_converted_audio": f"""WITH {WAVES}, mono AS (SELECT vec_id AS talk, list_transform(range(1, 33), lambda i: (x[i] + x[i + 32]) / 2) AS x FROM waves)
SELECT talk, pos, round_even(v * 1e6::DOUBLE, 0)::BIGINT AS micro FROM ({sinc("mono", 147, 160, 16)})""",
    "q38_settings": """SELECT event_id, CASE WHEN event_id % 3 = 1 THEN event_type ELSE 'safe' END AS audio_mode, '300' AS chunk_seconds,
       ['sinc_fast', 'sinc_best', 'kaiser_fast', 'kaiser_best'][user_id % 4 + 1] AS asked_method, 'linear' AS used_method FROM events""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
