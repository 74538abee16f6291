"""Predicates, joins, aggregates, windows, pages and unions over the league, as declarative SQL."""

from __future__ import annotations

from leaguespark.plans.league import EVENTS_NOW, NOW, League

_reg = League()
QUERIES, ORACLES = _reg.queries, _reg.oracles
_same = _reg.same

_STAR = """{matchs} m JOIN {equipes} ed ON ed.id = m.equipe_dom_id JOIN {equipes} ee ON ee.id = m.equipe_ext_id JOIN {poules} po ON po.id = m.poule_id
        JOIN {phases} ph ON ph.id = po.phase_id JOIN {competitions} co ON co.id = ph.competition_id"""

# Predicates.
_same("P3_any_array", "SELECT id, statut FROM {matchs} WHERE array_contains(array(1, 5, 9), journee)", "SELECT id, statut FROM {matchs} WHERE journee = ANY([1, 5, 9])")
_same("P4_closed_range", "SELECT id FROM {matchs} WHERE date_heure >= TIMESTAMP '1997-01-01 20:00:00' AND date_heure <= TIMESTAMP '1997-03-31 20:00:00'")
_same("P12_not_like", "SELECT path, count(*) AS n FROM {api_logs} WHERE path NOT LIKE '/v1/error%' AND path NOT IN ('/v1/views/1', '/v1/clicks/2') GROUP BY path")
_same("P13_nullif", "SELECT poule_id, round(CAST(sum(score_dom) AS DOUBLE) / nullif(CAST(sum(score_ext) AS DOUBLE), 0), 6) AS ratio FROM {matchs} GROUP BY poule_id")
_same("P14_distinct", "SELECT DISTINCT c.equipe_id, substr(j.numero_licence, 1, 7) AS code FROM {compositions} c JOIN {joueurs} j ON j.id = c.joueur_id")
_same("P17_integrity", """
    SELECT 'match_sans_poule' AS probe, EXISTS (SELECT 1 FROM {matchs} m WHERE NOT EXISTS (SELECT 1 FROM {poules} p WHERE p.id = m.poule_id)) AS broken
    UNION ALL SELECT 'match_sans_equipe', EXISTS (SELECT 1 FROM {matchs} m WHERE NOT EXISTS (SELECT 1 FROM {equipes} e WHERE e.id = m.equipe_ext_id))
    UNION ALL SELECT 'meme_equipe', EXISTS (SELECT 1 FROM {matchs} WHERE equipe_dom_id = equipe_ext_id)
    UNION ALL SELECT 'score_negatif', EXISTS (SELECT 1 FROM {matchs} WHERE score_dom < 0 OR score_ext < 0)
    UNION ALL SELECT 'phase_sans_competition', EXISTS (SELECT 1 FROM {phases} ph WHERE NOT EXISTS (SELECT 1 FROM {competitions} c WHERE c.id = ph.competition_id))
    UNION ALL SELECT 'saison_invalide', EXISTS (SELECT 1 FROM {saisons} WHERE date_fin <= date_debut)""")
_same("P18_json_path", "SELECT id, job FROM {runs} WHERE get_json_object(stats, '$.k') = '42'", "SELECT id, job FROM {runs} WHERE json_extract_string(stats, '$.k') = '42'")

# Joins.
_same("J2_role_playing", "SELECT m.id, ed.nom AS equipe_dom, ee.nom AS equipe_ext FROM {matchs} m JOIN {equipes} ed ON ed.id = m.equipe_dom_id JOIN {equipes} ee ON ee.id = m.equipe_ext_id")
_same("J4_hierarchy", "SELECT po.id_ffhb AS poule, ph.nom AS phase, co.nom AS competition FROM {poules} po JOIN {phases} ph ON ph.id = po.phase_id JOIN {competitions} co ON co.id = ph.competition_id")
_same("J8_semi_in", "SELECT id, nom FROM {equipes} WHERE id IN (SELECT c.equipe_id FROM {compositions} c JOIN {joueurs} j ON j.id = c.joueur_id WHERE substr(j.numero_licence, 1, 7) = '0000365')")
_same("J11_left_null", "SELECT e.id, e.nom FROM {equipes} e LEFT JOIN (SELECT DISTINCT equipe_ext_id FROM {matchs}) m ON m.equipe_ext_id = e.id WHERE m.equipe_ext_id IS NULL")
_same("J12_using_flag", """
    SELECT poule_id, journee, coalesce(held, false) AS en_base FROM (SELECT DISTINCT poule_id, journee FROM {matchs} WHERE journee IS NOT NULL) s
    LEFT JOIN (SELECT poule_id, journee, true AS held FROM {matchs} WHERE journee IS NOT NULL GROUP BY poule_id, journee HAVING NOT bool_or(statut = 'a_jouer')) b USING (poule_id, journee)""")
_same("J14_json_key", """
    SELECT m.id, e.event_id FROM (SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM {events}) e JOIN {matchs} m ON m.id = e.k""", """
    SELECT m.id, e.event_id FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM {events}) e JOIN {matchs} m ON m.id = e.k""")
_same("J15_hash_lookup", "SELECT a.match_id, a.ordre, m.poule_id, m.fdm_code FROM {actions} a LEFT JOIN (SELECT id, poule_id, fdm_code FROM {matchs} WHERE fdm_code IS NOT NULL) m ON m.id = a.match_id")
_same("J16_by_id_else_by_name", """
    SELECT e.id, coalesce(i.id_ffhb, n.id_ffhb) AS club, CASE WHEN i.id_ffhb IS NOT NULL THEN 'id' WHEN n.id_ffhb IS NOT NULL THEN 'nom' END AS par
    FROM {equipes} e LEFT JOIN {clubs} i ON i.id_ffhb = e.ext_structure_id LEFT JOIN (SELECT nom, min(id_ffhb) AS id_ffhb FROM {clubs} GROUP BY nom) n ON n.nom = e.nom""")
_same("J17_fk_lookups", """
    SELECT m.id, ed.id_ffhb AS dom, ee.id_ffhb AS ext, CASE WHEN ed.id IS NULL THEN 'dom' WHEN ee.id IS NULL THEN 'ext' WHEN po.id IS NULL THEN 'poule' END AS warning
    FROM {matchs} m LEFT JOIN {equipes} ed ON ed.id = m.equipe_dom_id LEFT JOIN {equipes} ee ON ee.id = m.equipe_ext_id LEFT JOIN {poules} po ON po.id = m.poule_id""")
_SHIRTS = """
    SELECT a.match_id, a.ordre, c.joueur_id FROM {actions} a LEFT JOIN (
      SELECT match_id, cote, numero_maillot, max(joueur_id) AS joueur_id FROM {compositions} WHERE numero_maillot IS NOT NULL GROUP BY match_id, cote, numero_maillot) c
    ON c.match_id = a.match_id AND c.cote = a.cote AND c.numero_maillot = a.ordre"""
_reg.add("J18_shirt_to_player", _SHIRTS)(lambda t: t.dealt().sql(_SHIRTS))
_same("J19_comma_join", """
    SELECT m.id, ed.nom AS dom, ee.nom AS ext, po.nom AS poule, co.nom AS competition FROM {matchs} m, {equipes} ed, {equipes} ee, {poules} po, {phases} ph, {competitions} co
    WHERE ed.id = m.equipe_dom_id AND ee.id = m.equipe_ext_id AND po.id = m.poule_id AND ph.id = po.phase_id AND co.id = ph.competition_id AND m.statut = 'forfait'""")
_same("J9_two_anti_joins", """
    SELECT m.id, m.fdm_code FROM {matchs} m WHERE m.fdm_code IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {actions} a WHERE a.match_id = m.id AND a.type_action = 'R')
    AND NOT EXISTS (SELECT 1 FROM {compositions} c WHERE c.match_id = m.id AND (c.numero_maillot IS NULL OR (c.but_count = 0 AND m.date_heure < TIMESTAMP '1999-01-01')))""")
_same("J10_seen_but_absent", """
    SELECT j.id, j.numero_licence FROM {joueurs} j WHERE NOT EXISTS (SELECT 1 FROM {compositions} c WHERE c.joueur_id = j.id AND c.but_count > 9)""")
_same("P8_causes_with_exists", """
    SELECT CASE WHEN m.statut = 'forfait' THEN 'forfait' WHEN EXISTS (SELECT 1 FROM {compositions} c WHERE c.match_id = m.id AND c.numero_maillot IS NULL) THEN 'feuille_incomplete'
                WHEN EXISTS (SELECT 1 FROM {actions} a WHERE a.match_id = m.id AND a.type_action = 'R') THEN 'reserve' WHEN m.fdm_code IS NULL THEN 'sans_feuille' ELSE 'inconnu' END AS cause, count(*) AS n
    FROM {matchs} m WHERE m.score_ext IS NULL GROUP BY 1""")

# Aggregates.
_same("A2_roster", "SELECT equipe_id, joueur_id, count(DISTINCT match_id) AS matchs, CAST(sum(but_count) AS BIGINT) AS buts FROM {compositions} GROUP BY equipe_id, joueur_id")
_same("A4_distinct_filter", "SELECT c.equipe_id, count(DISTINCT c.joueur_id) FILTER (WHERE substr(j.numero_licence, 1, 5) = '00003') AS joueurs FROM {compositions} c JOIN {joueurs} j ON j.id = c.joueur_id GROUP BY c.equipe_id")
_same("A6_rounded_average", "SELECT path, round(avg(duration_ms), 3) AS moyenne FROM {api_logs} GROUP BY path")
_same("A9_last_success", "SELECT job, max(started_at) AS dernier, max(finished_at) FILTER (WHERE status = 'success') AS dernier_succes FROM {runs} GROUP BY job")
_same("A10_computed_key", "SELECT CASE WHEN status >= 500 THEN 'erreur' WHEN status >= 400 THEN 'absent' ELSE 'ok' END AS cause, count(*) AS n FROM {api_logs} GROUP BY 1")
_same("A12_mode", """
    SELECT equipement_id, ville, n FROM (SELECT m.equipement_id, s.n_name AS ville, count(*) AS n, row_number() OVER (PARTITION BY m.equipement_id ORDER BY count(*) DESC, s.n_name) AS rang
      FROM {matchs} m JOIN {customer} c ON c.c_custkey = m.equipe_dom_id JOIN {nation} s ON s.n_nationkey = c.c_nationkey WHERE m.equipement_id IS NOT NULL GROUP BY m.equipement_id, s.n_name) t WHERE rang = 1""")
_same("A13_active_poules", """
    SELECT co.niveau, count(DISTINCT po.id) AS poules, count(*) AS matchs FROM {matchs} m JOIN {poules} po ON po.id = m.poule_id JOIN {phases} ph ON ph.id = po.phase_id JOIN {competitions} co ON co.id = ph.competition_id
    WHERE m.date_heure >= TIMESTAMP '1998-01-01' AND m.date_heure < TIMESTAMP '1998-02-01' GROUP BY co.niveau""")
_same("A14_volume", "SELECT job, count(*) AS total, count(DISTINCT pages) AS cles, max(started_at) AS dernier FROM {runs} GROUP BY job")
_same("A20_raw_vs_core", """
    SELECT coalesce(r.entite, c.entite) AS entite, coalesce(r.n, 0) AS brut, coalesce(c.n, 0) AS core FROM
      (SELECT 'matchs' AS entite, count(*) AS n FROM {orders} UNION ALL SELECT 'joueurs', count(*) FROM {part} UNION ALL SELECT 'licences', count(*) FROM {customer}) r
    FULL OUTER JOIN (SELECT 'matchs' AS entite, count(*) AS n FROM {matchs} UNION ALL SELECT 'joueurs', count(DISTINCT joueur_id) FROM {compositions}) c ON c.entite = r.entite""")

# Windows, pages, unions.
_same("W2_total_beside_page", "SELECT m.id, t.total FROM (SELECT id FROM {matchs} WHERE statut = 'joue' ORDER BY date_heure DESC, id DESC LIMIT 20) m CROSS JOIN (SELECT count(*) AS total FROM {matchs} WHERE statut = 'joue') t")
_same("W3_latest_standing", "SELECT equipe_id, poule_id, points FROM (SELECT equipe_id, poule_id, points, row_number() OVER (PARTITION BY equipe_id ORDER BY capture_date DESC, poule_id) AS nth FROM {classements}) t WHERE nth = 1")
_same("W4_latest_run", "SELECT job, max_by(status, id) AS status FROM {runs} GROUP BY job", "SELECT job, arg_max(status, id) AS status FROM {runs} GROUP BY job")
_same("L2_total_past_end", "SELECT t.total, p.id FROM (SELECT count(*) AS total FROM {matchs}) t LEFT JOIN (SELECT id FROM {matchs} ORDER BY date_heure DESC, id DESC LIMIT 20 OFFSET 100000000) p ON true")
_same("L3_keyset", "SELECT id, date_heure FROM {matchs} WHERE date_heure < TIMESTAMP '1998-06-01 20:00:00' OR (date_heure = TIMESTAMP '1998-06-01 20:00:00' AND id < 500) ORDER BY date_heure DESC, id DESC LIMIT 50")
_same("L5_nulls_last", "SELECT poule_id, joueur_id, total_buts FROM {stats_joueurs} ORDER BY total_buts DESC NULLS LAST, match_count DESC, joueur_id, poule_id LIMIT 40")
_same("L8_calendar_order", "SELECT id FROM {matchs} WHERE equipe_dom_id = 7 OR equipe_ext_id = 7 ORDER BY date_heure, id")
_same("U4_ledgers", """
    SELECT source, max(fini) AS dernier, count(*) AS n FROM (SELECT 'run' AS source, finished_at AS fini FROM {runs} UNION ALL SELECT 'log', requested_at FROM {api_logs} UNION ALL SELECT 'match', date_heure FROM {matchs}) t GROUP BY source""")
_same("U5_labelled_counts", "SELECT 'clubs' AS entite, count(*) AS n FROM {clubs} UNION ALL SELECT 'equipes', count(*) FROM {equipes} UNION ALL SELECT 'matchs', count(*) FROM {matchs} UNION ALL SELECT 'actions', count(*) FROM {actions}")

# Time functions.
_same("F20_truncated_hours", f"""
    SELECT path, date_trunc('hour', max(requested_at)) AS heure, CAST(unix_timestamp(TIMESTAMP '{EVENTS_NOW}') - unix_timestamp(date_trunc('hour', max(requested_at))) AS BIGINT) AS secondes FROM {{api_logs}} GROUP BY path""", f"""
    SELECT path, date_trunc('hour', max(requested_at)) AS heure, CAST(epoch(TIMESTAMP '{EVENTS_NOW}' - date_trunc('hour', max(requested_at))) AS BIGINT) AS secondes FROM {{api_logs}} GROUP BY path""")
_same("F21_renewal", f"""
    SELECT key_prefix, date_format(add_months(CAST(greatest(coalesce(max(requested_at), TIMESTAMP '{EVENTS_NOW}'), TIMESTAMP '2024-01-30') AS DATE), 3), 'yyyy-MM-dd') AS expire FROM {{api_logs}} GROUP BY key_prefix""", f"""
    SELECT key_prefix, strftime(CAST(greatest(coalesce(max(requested_at), TIMESTAMP '{EVENTS_NOW}'), TIMESTAMP '2024-01-30') AS DATE) + INTERVAL 3 MONTH, '%Y-%m-%d') AS expire FROM {{api_logs}} GROUP BY key_prefix""")

# Logs, runs, retention.
_same("K15_age_purge", f"SELECT 'logs' AS journal, count(*) AS n FROM {{api_logs}} WHERE requested_at < TIMESTAMP '{EVENTS_NOW}' - INTERVAL 7 DAY UNION ALL SELECT 'warnings', count(*) FROM {{actions}} a WHERE a.match_id IN (SELECT id FROM {{matchs}} WHERE date_heure < TIMESTAMP '{NOW}' - INTERVAL 365 DAY)")
_same("K26_access_log", "SELECT id, path, status FROM {api_logs} WHERE path NOT LIKE '/v1/views/%'")
_same("S27_zipped_arrays", """
    SELECT x.a AS journee, x.b AS debut, x.c AS fin FROM (SELECT explode(arrays_zip(a, b, c)) AS x FROM (
      SELECT array(1, 2, 3) AS a, array('2025-09-01', '2025-09-08', NULL) AS b, array('2025-09-07', '2025-09-14', '2025-09-21') AS c))""",
      "SELECT unnest([1, 2, 3]) AS journee, unnest(['2025-09-01', '2025-09-08', NULL]) AS debut, unnest(['2025-09-07', '2025-09-14', '2025-09-21']) AS fin")
_same("S26_hours", "SELECT date_format(hour, 'yyyy-MM-dd HH') AS hour FROM (SELECT explode(sequence(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-07 23:00:00', INTERVAL 1 HOUR)) AS hour)",
      "SELECT strftime(hour, '%Y-%m-%d %H') AS hour FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-07 23:00:00', INTERVAL 1 HOUR)) AS hour)")
_same("S23_table_access", "SELECT n_nationkey, n_name, r_name FROM {nation} JOIN {region} ON r_regionkey = n_regionkey WHERE n_regionkey = 2")
_same("S24_seeds", "SELECT saison_code, CAST(date_debut AS STRING) AS debut, CAST(date_fin AS STRING) AS fin FROM {saisons}")
