"""DuckDB SQL giving the expected result of each query in :mod:`replylens.plans.queries`.

Where a query works on replies or insight documents built from the tables, the SQL
states the expected rows directly instead of parsing JSON a second time.
"""

from __future__ import annotations

from replylens.operators import insights
from replylens.operators.annotation import CONTRACT, FAILURES, INSTRUCTIONS, MAX_TRIES
from replylens.operators.embedding import DIMENSIONS
from replylens.operators.topics import STOP_WORDS

# Views over the driver tables; each is added to a query that names it, in this order.
VIEWS = {
    "raw_actions": """
        SELECT event_id AS id, event_id // 8 AS job_id,
               CASE WHEN k < 90 THEN CAST(k % 17 AS INTEGER) END AS detected_intent,
               CASE event_type WHEN 'purchase' THEN 'accepted' WHEN 'click' THEN 'EDITED'
                    WHEN 'error' THEN ' Ignored' WHEN 'view' THEN 'SKIPPED' END AS sender_action,
               CASE WHEN value >= 1 THEN user_id END AS sender_id,
               ts AS created_at, ts AS synced_at, event_type, k
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "flagged": """
        SELECT * REPLACE (upper(trim(coalesce(sender_action, ''))) AS sender_action),
               coalesce(event_type = 'purchase', false) AS suggestion_accepted,
               coalesce(event_type = 'click', false) AS suggestion_edited,
               coalesce(event_type = 'error', false) AS suggestion_ignored,
               coalesce(event_type = 'view', false) AS suggestion_skipped,
               event_type IN ('click', 'error', 'view') AS needs_analysis
        FROM raw_actions""",
    "text_pairs": """
        SELECT a.doc_id, a.text AS asked, b.text AS suggested
        FROM documents a
        LEFT JOIN documents b ON b.doc_id = (a.doc_id * 7 + 3) % (SELECT count(*) FROM documents)""",
    "raw_messages": """
        SELECT r.id, r.job_id, r.detected_intent,
               CASE WHEN k <> 7 THEN asked END AS message_input,
               CASE WHEN k <> 13 THEN suggested END AS message_output,
               r.sender_action,
               CASE WHEN event_type = 'purchase' THEN suggested
                    WHEN event_type = 'click' AND k < 50 THEN replace(suggested, 'e', '')
                    WHEN event_type = 'click' THEN suggested || ' ' || asked
                    WHEN event_type = 'error' AND k >= 20 THEN replace(asked, 'a', '')
               END AS final_message_sent,
               r.sender_id, r.created_at, r.synced_at
        FROM raw_actions r
        LEFT JOIN text_pairs t ON t.doc_id = r.id % (SELECT count(*) FROM documents)""",
    "messages": """
        SELECT m.id, m.job_id, m.detected_intent,
               coalesce(message_input, '') AS message_input,
               coalesce(message_output, '') AS message_output,
               f.sender_action,
               coalesce(final_message_sent, '') AS final_message_sent,
               m.sender_id, m.created_at, m.synced_at,
               suggestion_accepted, suggestion_edited, suggestion_ignored, suggestion_skipped,
               needs_analysis,
               CASE WHEN suggestion_edited AND message_output <> '' AND final_message_sent <> ''
                    THEN abs(length(message_output) - length(final_message_sent))
                         / greatest(length(message_output), 1) * 100
                    ELSE 0.0 END AS edit_distance
        FROM raw_messages m JOIN flagged f ON f.id = m.id""",
    "analysed": """
        SELECT * FROM messages
        WHERE message_input <> '' AND message_output <> '' AND NOT suggestion_accepted""",
    "compared": "SELECT * FROM analysed WHERE final_message_sent <> ''",
    "stored": """
        SELECT id, message_input, message_output, final_message_sent,
               coalesce(CAST(job_id AS VARCHAR), 'N/A') AS job_id,
               coalesce(detected_intent, -1) AS detected_intent,
               sender_action,
               regexp_replace(strftime(created_at, '%Y-%m-%d %H:%M:%S.%f'), '\\.000000$', '')
                   AS created_at,
               coalesce(CAST(sender_id AS VARCHAR), 'N/A') AS sender_id,
               edit_distance
        FROM compared""",
    "stored_pairs": """
        SELECT 'pair_' || id AS id,
               'CUSTOMER: ' || message_input || chr(10) || 'SUGGESTION: ' || message_output
                   || chr(10) || 'FINAL: ' || final_message_sent AS document,
               message_output || ' ' || final_message_sent AS embed_text,
               job_id, detected_intent, sender_action, edit_distance, sender_id
        FROM stored WHERE sender_action IN ('EDITED', 'IGNORED')""",
    "batched": """
        SELECT *, place // 5 AS batch, CAST(place % 5 AS INTEGER) AS j,
               (place // 5) % 9 AS shape
        FROM (SELECT 'pair_' || id AS id, message_input, message_output, final_message_sent,
                     detected_intent, sender_action,
                     row_number() OVER (ORDER BY md5('pair_' || id), 'pair_' || id) - 1 AS place
              FROM stored WHERE sender_action IN ('EDITED', 'IGNORED'))""",
    "prompts": """
        SELECT batch, count(*) AS examples,
               $head || string_agg(
                   '## item ' || j || chr(10)
                   || '[asked] ' || message_input || chr(10)
                   || '[intent] ' || detected_intent || chr(10)
                   || '[proposed] ' || message_output || chr(10)
                   || '[sent] ' || final_message_sent || chr(10)
                   || '[outcome] ' || sender_action, chr(10) || chr(10) ORDER BY j) AS prompt
        FROM batched GROUP BY batch""",
    "answers": """
        SELECT batch, j, shape, status,
               shape = 5 AND j = 0 AS second,
               CASE WHEN shape = 6 AND j = 1 THEN 'error_missing' ELSE status END AS outcome,
               id, message_output, detected_intent, sender_action
        FROM (SELECT *, CASE WHEN shape IN (0, 1, 5, 6) THEN 'ok'
                             WHEN shape IN (2, 8) THEN 'error_format'
                             WHEN shape IN (3, 7) THEN 'error_parsing'
                             ELSE 'error_api' END AS status
              FROM batched)""",
    "measured": """
        SELECT *, CAST(created_at AS DATE) AS date,
               CAST(hour(created_at) AS INTEGER) AS hour_of_day,
               dayname(created_at) AS day_of_week,
               CAST(week(created_at) AS INTEGER) AS week_of_year,
               CAST(suggestion_accepted AS INTEGER) AS accepted,
               CAST(suggestion_edited AS INTEGER) AS edited,
               CAST(suggestion_ignored AS INTEGER) AS ignored,
               CAST(suggestion_skipped AS INTEGER) AS skipped,
               CASE WHEN hour(created_at) <= 6 THEN 'Madrugada'
                    WHEN hour(created_at) <= 12 THEN 'Mañana'
                    WHEN hour(created_at) <= 18 THEN 'Tarde' ELSE 'Noche' END AS day_part
        FROM flagged""",
    "weekday_names": """
        SELECT * FROM (VALUES ('Monday', 'Lunes', 0), ('Tuesday', 'Martes', 1),
            ('Wednesday', 'Miércoles', 2), ('Thursday', 'Jueves', 3), ('Friday', 'Viernes', 4),
            ('Saturday', 'Sábado', 5), ('Sunday', 'Domingo', 6))
            AS t(day_of_week, day_of_week_es, day_order)""",
    "daily": "SELECT date, $stats FROM measured GROUP BY date",
    "weekdays": """
        SELECT s.*, day_of_week_es, day_order
        FROM (SELECT day_of_week, $stats FROM measured GROUP BY day_of_week) s
        JOIN weekday_names USING (day_of_week)""",
    "hourly": "SELECT hour_of_day, $stats FROM measured GROUP BY hour_of_day",
    "agents": """
        SELECT sender_id, $stats FROM measured WHERE sender_id IS NOT NULL GROUP BY sender_id""",
    "intents": """
        SELECT date, detected_intent, count(*) AS total_messages,
               CAST(sum(accepted) AS BIGINT) AS accepted,
               round_even(sum(accepted) / count(*) * 100, 2) AS acceptance_rate
        FROM measured WHERE detected_intent IS NOT NULL GROUP BY date, detected_intent""",
    "analysis": """
        SELECT t.doc_id AS id, asked AS customer_message, suggested AS suggested_response,
               replace(suggested, 'e', '') AS final_response,
               CASE WHEN coalesce(toxic, 0) = 0 THEN asked END AS rejection_reason,
               CASE WHEN quality IS NULL THEN 'desconocido' WHEN quality = 0 THEN 'otro'
                    WHEN lang = 'en' THEN 'tono' WHEN lang = 'fr' THEN 'información_faltante'
                    WHEN lang = 'de' THEN 'formato' ELSE 'inexacto' END AS rejection_category,
               CASE WHEN number = 18 THEN -1 WHEN number < 18 THEN number % 5 END AS cluster
        FROM text_pairs t
        JOIN (SELECT doc_id, lang, CAST(substr(source, 4) AS INTEGER) AS number FROM documents) d
            ON d.doc_id = t.doc_id
        LEFT JOIN labels l ON l.doc_id = t.doc_id""",
    "words": """
        SELECT id, cluster, [x FOR x IN regexp_extract_all(
                   lower(coalesce(rejection_reason, 'Desconocido')), '[\\p{L}\\p{N}_]{2,}')
               IF x NOT IN ($stop_words)] AS w
        FROM analysis""",
    "grams": """
        SELECT id, cluster, unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS term
        FROM words""",
    "vocab": """
        SELECT term, count(DISTINCT id) AS document_frequency, count(*) AS term_frequency
        FROM grams GROUP BY term HAVING count(DISTINCT id) >= 3
        ORDER BY term_frequency DESC, term LIMIT 1000""",
    "weights": """
        SELECT id, cluster, term, tfidf / sqrt(sum(tfidf * tfidf) OVER (PARTITION BY id)) AS weight
        FROM (SELECT id, cluster, term,
                     count(*) * (ln((1 + (SELECT count(*) FROM analysis))
                                    / (1 + any_value(document_frequency))) + 1) AS tfidf
              FROM grams JOIN vocab USING (term) GROUP BY id, cluster, term)""",
    "heaviest": """
        SELECT cluster, term, weight,
               row_number() OVER (PARTITION BY cluster ORDER BY weight DESC, term) AS rank
        FROM (SELECT w.cluster, term, round(sum(weight) / any_value(members), 9) AS weight
              FROM weights w
              JOIN (SELECT cluster, count(*) AS members FROM analysis GROUP BY cluster) m
                  ON m.cluster = w.cluster
              WHERE w.cluster >= 0 GROUP BY w.cluster, term)""",
    "sizes": """
        SELECT cluster, count(*) AS examples,
               round(count(*) / (SELECT count(*) FROM analysis) * 100, 6) AS percentage
        FROM analysis WHERE cluster >= 0 GROUP BY cluster""",
    "examples": """
        SELECT cluster, pick, id, customer_message, suggested_response, final_response,
               rejection_reason
        FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY md5(id || ':42'), id)
                        AS pick
              FROM analysis WHERE cluster >= 0)
        WHERE pick <= 3""",
}

STATS = """count(*) AS total_messages, CAST(sum(accepted) AS BIGINT) AS accepted,
    CAST(sum(edited) AS BIGINT) AS edited, CAST(sum(ignored) AS BIGINT) AS ignored,
    CAST(sum(skipped) AS BIGINT) AS skipped,
    round_even(sum(accepted) / count(*) * 100, 2) AS acceptance_rate"""

FLAGS = """suggestion_accepted, suggestion_edited, suggestion_ignored, suggestion_skipped,
    needs_analysis"""

BODIES = {
    "scan_messages": "SELECT * FROM raw_messages",
    "clean_messages": "SELECT * FROM messages",
    "action_flags": "SELECT id, sender_action, $flags FROM flagged",
    "edit_distance": "SELECT id, sender_action, edit_distance FROM messages",
    "analysis_set": """
        SELECT id, detected_intent, sender_action, $flags, edit_distance FROM analysed""",
    "comparison_set": """
        SELECT id, sender_action, edit_distance, length(message_input) AS message_length,
               length(message_output) AS suggestion_length,
               length(final_message_sent) AS final_length
        FROM compared""",
    "coerce_columns": """
        SELECT event_id AS id,
               CASE WHEN k <> 3 THEN CAST(event_id // 8 AS VARCHAR) ELSE 'N/A' END AS job_id,
               CASE WHEN k < 90 THEN k % 17 ELSE -1 END AS detected_intent,
               CASE WHEN event_type <> 'signup' THEN upper(event_type) ELSE 'N/A' END
                   AS sender_action,
               CASE WHEN value >= 1 THEN CAST(user_id AS VARCHAR) ELSE 'N/A' END AS sender_id,
               CASE WHEN k >= 5 THEN value ELSE 0.0 END AS edit_distance,
               CASE WHEN k <> 0 THEN ts END AS created_at
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "preview_rejects": """
        SELECT id, sender_action, substr(message_input, 1, 50) AS input_preview,
               substr(message_output, 1, 50) AS output_preview,
               substr(final_message_sent, 1, 50) AS final_preview
        FROM messages WHERE needs_analysis ORDER BY id LIMIT 5""",
    "date_range": """
        SELECT id, created_at, sender_action, sender_id FROM flagged
        WHERE created_at >= TIMESTAMP '2024-01-10' AND created_at <= TIMESTAMP '2024-01-20'""",
    "dataset_stats": """
        SELECT count(*) AS total_messages, count(DISTINCT detected_intent) AS unique_intents,
               count(DISTINCT sender_id) AS unique_agents,
               round(avg(CAST(suggestion_accepted AS INTEGER)) * 100, 6) AS acceptance_rate,
               round(avg(CAST(suggestion_edited AS INTEGER)) * 100, 6) AS edit_rate,
               round(avg(CAST(suggestion_ignored AS INTEGER)) * 100, 6) AS ignore_rate,
               round(avg(CAST(suggestion_skipped AS INTEGER)) * 100, 6) AS skip_rate,
               round(avg(length(message_input)), 6) AS avg_message_length,
               round(avg(length(message_output)), 6) AS avg_suggestion_length,
               round(avg(length(final_message_sent)), 6) AS avg_final_length
        FROM messages""",
    "intent_distribution": """
        SELECT detected_intent, count(*) AS messages FROM raw_actions
        WHERE detected_intent IS NOT NULL GROUP BY detected_intent""",
    "action_breakdown": """
        SELECT sender_action, count(*) AS messages FROM raw_actions GROUP BY sender_action""",
    "presence_counts": """
        SELECT count(message_input) AS message_input_present,
               count(message_output) AS message_output_present,
               count(final_message_sent) AS final_message_sent_present
        FROM raw_messages""",
    "sample_by_action": """
        SELECT sender_action, pick, id, message_input AS input, message_output AS suggestion,
               final_message_sent AS final, detected_intent AS intent
        FROM (SELECT *, row_number() OVER (PARTITION BY sender_action
                                           ORDER BY md5(id || ':42'), id) AS pick
              FROM messages WHERE sender_action <> '')
        WHERE pick <= 5""",
    "sample_messages": """
        SELECT id, job_id, detected_intent, sender_action, sender_id, created_at
        FROM flagged ORDER BY md5(id || ':42'), id LIMIT 5000""",
    "sample_by_user": """
        SELECT event_type, pick, user_id
        FROM (SELECT event_type, user_id,
                     row_number() OVER (PARTITION BY event_type
                                        ORDER BY md5(user_id || ':42'), user_id) AS pick
              FROM events)
        WHERE pick <= 5""",
    "sample_by_user_large": """
        SELECT event_type, pick, user_id
        FROM (SELECT event_type, user_id,
                     row_number() OVER (PARTITION BY event_type
                                        ORDER BY md5(user_id || ':42'), user_id) AS pick
              FROM events)
        WHERE pick <= 2000""",
    "csv_messages": """
        SELECT * REPLACE (nullif(message_input, '') AS message_input,
                          nullif(message_output, '') AS message_output,
                          nullif(final_message_sent, '') AS final_message_sent)
        FROM raw_messages""",
    "time_features": """
        SELECT id, date, day_of_week, hour_of_day, week_of_year,
               CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name, day_part
        FROM measured""",
    "daily_stats": """
        SELECT *, round(100.0 - acceptance_rate, 6) AS rejection_rate,
               round(avg(acceptance_rate) OVER (
                   ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS acceptance_ma7
        FROM daily""",
    "weekday_stats": "SELECT * FROM weekdays",
    "hourly_stats": "SELECT * FROM hourly",
    "daypart_stats": """
        SELECT p.day_part, coalesce(total_messages, 0) AS total_messages,
               coalesce(accepted, 0) AS accepted, coalesce(edited, 0) AS edited,
               coalesce(ignored, 0) AS ignored, coalesce(skipped, 0) AS skipped, acceptance_rate
        FROM (VALUES ('Madrugada'), ('Mañana'), ('Tarde'), ('Noche')) AS p(day_part)
        LEFT JOIN (SELECT day_part, $stats FROM measured GROUP BY day_part) s
            ON s.day_part = p.day_part""",
    "agent_stats": "SELECT * FROM agents",
    "top_agents": "SELECT * FROM agents ORDER BY total_messages DESC, sender_id LIMIT 20",
    "intent_daily": "SELECT * FROM intents",
    "intent_trend_top5": """
        SELECT * FROM intents WHERE detected_intent IN (
            SELECT detected_intent FROM flagged WHERE detected_intent IS NOT NULL
            GROUP BY detected_intent ORDER BY count(*) DESC, detected_intent LIMIT 5)""",
    "weekly_stats": "SELECT week_of_year, $stats FROM measured GROUP BY week_of_year",
    "action_volumes_long": """
        SELECT date, variable, value
        FROM daily UNPIVOT (value FOR variable IN (accepted, edited, ignored, skipped))""",
    "weekday_volumes_long": """
        SELECT day_of_week, variable, value
        FROM weekdays UNPIVOT (value FOR variable IN (accepted, edited, ignored, skipped))""",
    "agent_volumes_long": """
        SELECT sender_id, variable, value
        FROM agents UNPIVOT (value FOR variable IN (accepted, edited, ignored, skipped))""",
    "time_summary": """
        SELECT round((SELECT sum(accepted) / sum(total_messages) * 100 FROM daily), 6)
                   AS overall_acceptance,
               CAST(bd.date AS VARCHAR) AS best_day, bd.acceptance_rate AS best_day_rate,
               CAST(wd.date AS VARCHAR) AS worst_day, wd.acceptance_rate AS worst_day_rate,
               bw.day_of_week_es AS best_weekday, bw.acceptance_rate AS best_weekday_rate,
               ww.day_of_week_es AS worst_weekday, ww.acceptance_rate AS worst_weekday_rate,
               CAST(bh.hour_of_day AS VARCHAR) AS best_hour, bh.acceptance_rate AS best_hour_rate,
               CAST(wh.hour_of_day AS VARCHAR) AS worst_hour, wh.acceptance_rate AS worst_hour_rate,
               (wh.hour_of_day + 2) % 24 AS worst_hour_end,
               (SELECT max_by(acceptance_rate, date) > min_by(acceptance_rate, date) FROM daily)
                   AS trend_rising,
               coalesce((SELECT avg(acceptance_rate) FILTER (row <= 5)
                                > avg(acceptance_rate) FILTER (row > 5)
                         FROM (SELECT *, row_number() OVER (ORDER BY day_order) AS row
                               FROM weekdays)), false) AS first_five_weekdays_better,
               coalesce((SELECT avg(acceptance_rate) FILTER (row BETWEEN 7 AND 12)
                                > avg(acceptance_rate) FILTER (row BETWEEN 13 AND 18)
                         FROM (SELECT *, row_number() OVER (ORDER BY hour_of_day) AS row
                               FROM hourly)), false) AS morning_better
        FROM (SELECT * FROM daily ORDER BY acceptance_rate DESC, date LIMIT 1) bd,
             (SELECT * FROM daily ORDER BY acceptance_rate, date LIMIT 1) wd,
             (SELECT * FROM weekdays ORDER BY acceptance_rate DESC, day_order LIMIT 1) bw,
             (SELECT * FROM weekdays ORDER BY acceptance_rate, day_order LIMIT 1) ww,
             (SELECT * FROM hourly ORDER BY acceptance_rate DESC, hour_of_day LIMIT 1) bh,
             (SELECT * FROM hourly ORDER BY acceptance_rate, hour_of_day LIMIT 1) wh""",
    "agent_summary": """
        SELECT min(acceptance_rate) AS min_rate, max(acceptance_rate) AS max_rate,
               count(*) FILTER (acceptance_rate >= 80) AS agents_on_target,
               coalesce(avg(acceptance_rate) FILTER (up <= 5)
                        > avg(acceptance_rate) FILTER (down <= 5), false)
                   AS busiest_agents_better
        FROM (SELECT *, row_number() OVER (ORDER BY total_messages DESC, sender_id) AS up,
                     row_number() OVER (ORDER BY total_messages, sender_id DESC) AS down
              FROM agents)""",
    "collection_customer": """
        SELECT CAST(id AS VARCHAR) AS id, message_input AS document, job_id, detected_intent,
               sender_action, created_at, sender_id FROM stored""",
    "collection_suggested": """
        SELECT 'sugg_' || id AS id, message_output AS document, job_id, detected_intent,
               sender_action, created_at, sender_id FROM stored""",
    "collection_final": """
        SELECT 'final_' || id AS id, final_message_sent AS document, job_id, detected_intent,
               sender_action, created_at, sender_id FROM stored""",
    "collection_pairs": "SELECT * FROM stored_pairs",
    "collection_counts": """
        SELECT 'customer_messages' AS collection, count(*) AS entries FROM stored
        UNION ALL SELECT 'suggested_responses', count(*) FROM stored
        UNION ALL SELECT 'final_responses', count(*) FROM stored
        UNION ALL SELECT 'rejected_pairs', count(*) FROM stored_pairs""",
    "upsert_collection": """
        SELECT CAST(id AS VARCHAR) AS id,
               CASE WHEN sender_action = 'EDITED' THEN final_message_sent
                    WHEN contains(message_output, 'the') THEN message_output
                    ELSE message_input END AS document
        FROM stored
        UNION ALL
        SELECT 'final_' || id, final_message_sent FROM stored WHERE sender_action = 'EDITED'""",
    "fetch_pairs": """
        SELECT id, document, job_id, detected_intent, sender_action, edit_distance, sender_id
        FROM stored_pairs ORDER BY id LIMIT 200""",
    "parse_pairs": """
        SELECT 'pair_' || id AS id, split_part(message_input, chr(10), 1) AS customer_message,
               split_part(message_output, chr(10), 1) AS suggested_response,
               split_part(final_message_sent, chr(10), 1) AS final_response,
               detected_intent, sender_action AS action, edit_distance
        FROM stored WHERE sender_action IN ('EDITED', 'IGNORED')""",
    "embed_texts": """
        WITH embedded_texts AS (
               SELECT 'customer_messages' AS collection, CAST(id AS VARCHAR) AS id,
                      message_input AS text FROM stored
               UNION ALL SELECT 'suggested_responses', 'sugg_' || id, message_output FROM stored
               UNION ALL SELECT 'final_responses', 'final_' || id, final_message_sent FROM stored
               UNION ALL SELECT 'rejected_pairs', id, embed_text FROM stored_pairs),
             tokens AS (
               SELECT collection, id,
                      unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS word
               FROM embedded_texts),
             hashed AS (
               SELECT collection, id,
                      CAST(CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % $dimensions AS INTEGER)
                          AS place, count(*) AS n
               FROM tokens GROUP BY ALL)
        SELECT collection, id, place,
               round(CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY collection, id)) AS FLOAT)
                          AS DOUBLE), 5) AS value
        FROM hashed""",
    "annotation_batches": """
        SELECT id, batch, j, detected_intent, sender_action AS action FROM batched""",
    "annotation_prompts": "SELECT * FROM prompts",
    "classify_replies": "SELECT DISTINCT batch, status FROM answers",
    "parse_replies": """
        SELECT batch, j,
               CASE WHEN second THEN 'segunda respuesta' ELSE message_output END
                   AS rejection_reason,
               CASE WHEN second THEN 'ninguna' ELSE sender_action END AS improvement_areas,
               CASE WHEN second THEN false ELSE detected_intent >= 0 END AS intent_accuracy,
               CASE WHEN second THEN 'otro' WHEN sender_action = 'EDITED' THEN 'tono'
                    ELSE 'inexacto' END AS rejection_category
        FROM answers WHERE outcome = 'ok'""",
    "quarantine_replies": """
        SELECT batch,
               CASE WHEN any_value(shape) = 3 THEN 'Sin respuesta para el lote ' || batch
                    ELSE '[' || string_agg(CAST(json_object(
                        'id', j, 'rejection_reason', message_output,
                        'improvement_areas', sender_action,
                        'intent_accuracy', detected_intent >= 0,
                        'rejection_category',
                        CASE WHEN sender_action = 'EDITED' THEN 'tono' ELSE 'inexacto' END)
                        AS VARCHAR), ', ' ORDER BY j) END AS reply
        FROM answers WHERE status = 'error_parsing' GROUP BY batch""",
    "attach_annotations": """
        SELECT id, batch, j, sender_action AS action,
               CASE outcome WHEN 'ok' THEN CASE WHEN second THEN 'segunda respuesta'
                                                ELSE message_output END
                    $failures END AS rejection_reason,
               CASE WHEN outcome <> 'ok' THEN '[]' WHEN second THEN 'ninguna'
                    ELSE sender_action END AS improvement_areas,
               CASE WHEN outcome = 'ok' THEN NOT second AND detected_intent >= 0 END
                   AS intent_accuracy,
               CASE WHEN outcome <> 'ok' THEN outcome WHEN second THEN 'otro'
                    WHEN sender_action = 'EDITED' THEN 'tono' ELSE 'inexacto' END
                   AS rejection_category
        FROM answers""",
    "run_annotator": """
        SELECT id, batch, j,
               CASE outcome WHEN 'ok' THEN length(prompt) || ':' || j $failures END
                   AS rejection_reason,
               CASE WHEN outcome <> 'ok' THEN outcome END AS rejection_category
        FROM (SELECT b.id, b.batch, b.j, prompt,
                     CASE WHEN length(prompt) % 7 = 1 THEN 'error_api' ELSE 'ok' END AS outcome
              FROM batched b JOIN prompts p ON p.batch = b.batch)""",
    "load_analysis": "SELECT id, rejection_reason, rejection_category, cluster FROM analysis",
    "tfidf_vocab": "SELECT * FROM vocab",
    "tfidf_weights": "SELECT id, term, round(weight, 6) AS weight FROM weights",
    "cluster_terms": """
        SELECT cluster, rank, term, round(weight, 6) AS weight FROM heaviest WHERE rank <= 10""",
    "cluster_counts": "SELECT * FROM sizes",
    "category_distribution": """
        SELECT rejection_category, count(*) AS examples,
               round(count(*) / (SELECT count(*) FROM analysis) * 100, 6) AS percentage
        FROM analysis GROUP BY rejection_category""",
    "category_by_cluster": """
        SELECT rejection_category, cluster, count(*) AS examples
        FROM analysis GROUP BY rejection_category, cluster""",
    "cluster_examples": "SELECT * FROM examples",
    "cluster_summary": """
        SELECT s.*, key_terms, example_ids, example_reasons
        FROM sizes s
        JOIN (SELECT cluster, string_agg(term, ', ' ORDER BY rank) AS key_terms
              FROM heaviest WHERE rank <= 10 GROUP BY cluster) t ON t.cluster = s.cluster
        LEFT JOIN (SELECT cluster, string_agg(CAST(id AS VARCHAR), ', ' ORDER BY pick)
                              AS example_ids,
                          string_agg(coalesce(rejection_reason, 'Desconocido'), chr(10)
                                     ORDER BY pick) AS example_reasons
                   FROM examples GROUP BY cluster) e ON e.cluster = s.cluster""",
    "insight_prompt": """
        SELECT $insight_head || (
                   SELECT string_agg('## cluster ' || s.cluster || ': ' || s.examples || ' rows' || chr(10)
                                     || '[terms] ' || key_terms || chr(10) || coalesce(shown, ''),
                                     chr(10) ORDER BY s.cluster)
                   FROM sizes s
                   JOIN (SELECT cluster, string_agg(term, ', ' ORDER BY rank) AS key_terms
                         FROM heaviest WHERE rank <= 10 GROUP BY cluster) t ON t.cluster = s.cluster
                   LEFT JOIN (SELECT cluster, string_agg(
                                  '### example ' || pick || chr(10)
                                  || '[asked] ' || customer_message || chr(10)
                                  || '[proposed] ' || suggested_response || chr(10)
                                  || '[sent] ' || final_response || chr(10)
                                  || '[reason] ' || coalesce(rejection_reason, 'N/A'),
                                  chr(10) ORDER BY pick) AS shown
                              FROM examples GROUP BY cluster) e ON e.cluster = s.cluster)
               || chr(10) || '## categories' || chr(10) || (
                   SELECT string_agg('- ' || rejection_category || ': ' || n, chr(10)
                                     ORDER BY n DESC, rejection_category)
                   FROM (SELECT rejection_category, count(*) AS n FROM analysis
                         GROUP BY rejection_category)) AS prompt""",
    # The axes of the covariance matrix by repeated squaring, the second after taking out the first.
    "pca_2d": """
        WITH RECURSIVE entries AS (
               SELECT vec_id, unnest(generate_series(1, len(embedding))) AS i,
                      CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
             centred AS (SELECT vec_id, i, v - avg(v) OVER (PARTITION BY i) AS v FROM entries),
             covariance AS (
               SELECT a.i, b.i AS j, sum(a.v * b.v) AS c FROM centred a JOIN centred b USING (vec_id) GROUP BY a.i, b.i),
             powers AS (
               SELECT 0 AS k, i, j, c / max(abs(c)) OVER () AS c FROM covariance
               UNION ALL
               SELECT k, i, j, c / max(abs(c)) OVER () FROM (
                 SELECT any_value(a.k) + 1 AS k, a.i, b.j, sum(a.c * b.c) AS c
                 FROM powers a JOIN powers b ON a.j = b.i WHERE a.k < 20 GROUP BY a.i, b.j)),
             first_column AS (
               SELECT i, c FROM powers WHERE k = 20 AND j = (
                 SELECT i FROM powers WHERE k = 20 AND i = j ORDER BY c DESC, i LIMIT 1)),
             first_axis AS (SELECT i, sign(max_by(c, abs(c)) OVER ()) * c / sqrt(sum(c * c) OVER ()) AS c FROM first_column),
             value AS (
               SELECT sum(f.c * m.c * g.c) AS v FROM covariance m JOIN first_axis f ON f.i = m.i JOIN first_axis g ON g.i = m.j),
             rest AS (
               SELECT m.i, m.j, m.c - v * f.c * g.c AS c
               FROM covariance m JOIN first_axis f ON f.i = m.i JOIN first_axis g ON g.i = m.j, value),
             rest_powers AS (
               SELECT 0 AS k, i, j, c / max(abs(c)) OVER () AS c FROM rest
               UNION ALL
               SELECT k, i, j, c / max(abs(c)) OVER () FROM (
                 SELECT any_value(a.k) + 1 AS k, a.i, b.j, sum(a.c * b.c) AS c
                 FROM rest_powers a JOIN rest_powers b ON a.j = b.i WHERE a.k < 20 GROUP BY a.i, b.j)),
             second_column AS (
               SELECT i, c FROM rest_powers WHERE k = 20 AND j = (
                 SELECT i FROM rest_powers WHERE k = 20 AND i = j ORDER BY c DESC, i LIMIT 1)),
             second_axis AS (SELECT i, sign(max_by(c, abs(c)) OVER ()) * c / sqrt(sum(c * c) OVER ()) AS c FROM second_column),
             plane AS (
               SELECT vec_id, sum(v * f.c) AS x, sum(v * s.c) AS y
               FROM centred n JOIN first_axis f ON f.i = n.i JOIN second_axis s ON s.i = n.i GROUP BY vec_id)
        SELECT vec_id, label,
               round(x, 4) + 0.0 AS x_pca,
               round(y, 4) + 0.0 AS y_pca
        FROM plane JOIN embeddings USING (vec_id)""",
    "flatten_insights": """
        WITH d AS (SELECT doc_id AS id, text, lang, source, string_split(text, chr(10)) AS lines
                   FROM documents),
             numbered AS (SELECT id, lang, unnest(lines) AS line,
                                 generate_subscripts(lines, 1) - 1 AS position FROM d)
        SELECT id, 'summary' AS section, NULL AS cluster, 0 AS position,
               CASE WHEN lang = 'de' THEN 'N/A' ELSE text END AS text,
               NULL AS impact, NULL AS effort, NULL AS related_clusters
        FROM d WHERE lang IN ('en', 'fr', 'de')
        UNION ALL SELECT id, 'finding', NULL, position, line, NULL, NULL, NULL
        FROM numbered WHERE lang IN ('en', 'fr')
        UNION ALL SELECT id, 'recommendation', NULL, 0,
               CASE WHEN lang = 'de' THEN 'N/A' ELSE source END,
               CASE WHEN lang = 'en' THEN 'Alto' ELSE 'N/A' END,
               CASE WHEN lang = 'en' THEN 'Bajo' ELSE 'N/A' END,
               CASE WHEN lang = 'en' THEN '0, 2' ELSE '' END
        FROM d WHERE lang IN ('en', 'fr', 'de')
        UNION ALL SELECT id, 'cluster_improvement', '0', position, line, NULL, NULL, NULL
        FROM numbered WHERE lang = 'en'
        UNION ALL SELECT id, 'cluster_improvement', '1', 0, NULL, NULL, NULL, NULL
        FROM d WHERE lang = 'en'
        UNION ALL SELECT id, 'intent_hint', NULL, 0, lang, NULL, NULL, NULL
        FROM d WHERE lang = 'en'
        UNION ALL SELECT id, 'next_step', NULL, 0, source, NULL, NULL, NULL
        FROM d WHERE lang = 'en'
        UNION ALL SELECT id, 'next_step', NULL, 1, lang, NULL, NULL, NULL
        FROM d WHERE lang = 'en'""",
    "quarantine_insights": """
        SELECT doc_id AS id, 'Sin JSON: ' || text AS document
        FROM documents WHERE lang NOT IN ('en', 'fr', 'de')""",
}

SUMS = """count(*) AS rows, CAST(sum(total_messages) AS BIGINT) AS messages, CAST(sum(accepted) AS BIGINT) AS accepted,
    CAST(sum(edited) AS BIGINT) AS edited, round(sum(acceptance_rate), 4) AS rates"""
STATISTICS = ["daily_stats", "weekday_stats", "hourly_stats", "daypart_stats", "agent_stats", "weekly_stats"]
IN_RANGE = BODIES["date_range"]

# What a sink wrote and a reader gave back is what was to be written.
BODIES |= {
    "csv_files": BODIES["csv_messages"],
    "stored_collection": BODIES["upsert_collection"],
    "stored_annotations": BODIES["attach_annotations"],
    "stored_sets": """
        SELECT 'analysis' AS dataset, id, sender_action, edit_distance FROM analysed
        UNION ALL SELECT 'comparison', id, sender_action, edit_distance FROM compared""",
    "stored_profile": """
        SELECT 'stats' AS part, 'total_messages' AS item, count(*) AS value FROM flagged
        UNION ALL SELECT 'action_breakdown', sender_action, count(*) FROM flagged GROUP BY sender_action
        UNION ALL SELECT 'intent_distribution', CAST(detected_intent AS VARCHAR), count(*) FROM flagged
        WHERE detected_intent IS NOT NULL GROUP BY detected_intent""",
    "stored_statistics": " UNION ALL ".join(
        f"SELECT '{name}' AS name, $sums FROM ({BODIES[name]})" for name in STATISTICS
    ),
    "stored_insights": """
        SELECT doc_id AS id, CASE WHEN lang <> 'de' THEN text END AS summary,
               CASE WHEN lang <> 'de' THEN len(string_split(text, chr(10))) ELSE 0 END AS findings
        FROM documents WHERE lang IN ('en', 'fr', 'de')""",
    "whole_run": f"""
        SELECT 'messages' AS item, count(*) AS entries FROM raw_messages
        UNION ALL SELECT 'analysis_dataset', count(*) FROM analysed
        UNION ALL SELECT 'comparison_dataset', count(*) FROM compared
        UNION ALL SELECT 'annotation/batches', count(*) FROM stored_pairs
        UNION ALL SELECT 'annotation/quarantine', 0
        UNION ALL SELECT 'rejection_analysis', count(*) FROM stored_pairs
        UNION ALL SELECT 'clustered', count(*) FROM stored_pairs
        UNION ALL SELECT 'insights/reasons_2d', count(*) FROM stored_pairs
        UNION ALL SELECT * FROM ({BODIES["collection_counts"]})
        UNION ALL SELECT 'messages in range', count(*) FROM ({IN_RANGE})
        UNION ALL SELECT 'clusters', 5""",
    # A fit is right if its rows are nearest to their own centre and its centres are means.
    "cluster_reasons": "SELECT id, true AS at_nearest FROM analysis",
    "cluster_centres": "SELECT term, 5 AS centres, 5 AS means FROM vocab",
}


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _filled(sql: str) -> str:
    values = {
        "$sums": SUMS,
        "$stats": STATS,
        "$flags": FLAGS,
        "$head": _literal(f"{INSTRUCTIONS}\n\n{CONTRACT}\n\n"),
        "$insight_head": _literal(f"{insights.INSTRUCTIONS}\n\n{insights.CONTRACT}\n\n"),
        "$dimensions": str(DIMENSIONS),
        "$stop_words": ", ".join(map(_literal, STOP_WORDS)),
        "$failures": " ".join(
            f"WHEN {_literal(name)} THEN {_literal(text.format(tries=MAX_TRIES))}"
            for name, text in FAILURES.items()
        ),
    }
    for name, value in values.items():
        sql = sql.replace(name, value)
    return sql


def _needed(sql: str) -> list[str]:
    """Views that ``sql`` names, directly or through other views, in definition order."""
    wanted: set[str] = set()
    texts = [sql]
    while texts:
        words = set(texts.pop().replace("(", " ").replace(")", " ").replace(",", " ").split())
        for view in words & VIEWS.keys() - wanted:
            wanted.add(view)
            texts.append(VIEWS[view])
    return [view for view in VIEWS if view in wanted]


def oracle_sql() -> dict[str, str]:
    statements = {}
    for name, body in BODIES.items():
        views = [f"{view} AS ({VIEWS[view]})" for view in _needed(body)]
        inner = body.strip()
        if views and inner.startswith("WITH "):
            statement = f"WITH {', '.join(views)}, {inner.removeprefix('WITH ')}"
        elif views:
            statement = f"WITH {', '.join(views)} {inner}"
        else:
            statement = inner
        statements[name] = _filled(statement)
    return statements
