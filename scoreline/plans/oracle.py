"""The same queries as plain SQL, to compare results against an independent engine.

Each table is a named part with the parts it needs; a query's text is its parts in order and its own select.
Rounding is spelled out as in :func:`scoreline.functions.core.rnd`.
"""

from __future__ import annotations

import datetime

from ..functions.chat import EXPLORATION_LEXICON, FEATURE_LEXICON
from ..operators.charts import CHARTS, Rows, chart_sql
from ..sources.ops_adapter import INPUTS, plain_sql
from .catalogue import LEXICON, MATCH, ONE, TWO, VARIED
from .tables import AS_OF, PUBLISHED, STAMPED


def r(x: str, n: int) -> str:
    return f"(sign(({x})::double) * floor(abs(({x})::double) * {10**n}::double + 0.5000001::double) / {10**n}::double + 0.0::double)"


def ratio(a: str, b: str) -> str:
    return f"(({a})::double / nullif(({b})::double, 0))"


def day(n: int) -> str:
    return f"date '{AS_OF - datetime.timedelta(days=n)}'"


def wins(team: str = "team") -> str:
    return f"(case when {team} = 'Red' and redscore > bluescore then 1 when {team} = 'Blue' and bluescore > redscore then 1 else 0 end)"


def whole_words(pattern: str) -> str:
    """A pattern's word boundaries spelled out by letters and digits of all scripts, as the other engine knows only ASCII ones."""
    return pattern.replace(r"\b(", r"(?:^|[^\p{L}\p{N}_])(").replace(r")\b", r")(?:$|[^\p{L}\p{N}_])")


def chat(lower: bool) -> str:
    text = "coalesce(messagelower, '')" if lower else "coalesce(message, '')"
    lexicon = whole_words(EXPLORATION_LEXICON if lower else FEATURE_LEXICON)
    return f"""select logid, steamid, count(*) as chat_messages, avg(length(coalesce(message, ''))) as avg_message_length,
  cast(count(*) filter (regexp_matches(coalesce(message, ''), '^[A-Z0-9 !?.''\\-]+$')) as bigint) as all_caps_messages,
  cast(count(*) filter (regexp_matches({text}, '!{{2,}}')) as bigint) as intense_punctuation_messages,
  cast(count(*) filter (regexp_matches({text}, '{lexicon}')) as bigint) as negative_lexicon_hits
  from messages_base where steamid is not null group by logid, steamid"""


def last(n: int, c: str) -> str:
    return f"avg({c}) over (partition by steamid order by match_time, logid rows between {n - 1} preceding and current row)"


_KDA = ratio("kills + assists", "deaths")
_FORM = "rolling_5_avg_kills, rolling_10_avg_damage, rolling_10_avg_impact, rolling_10_kda_ratio, rolling_10_win_rate, rolling_10_negative_chat_ratio, form_delta_kills, form_delta_damage, form_delta_impact, momentum_label"
_MEASURES = "coalesce(kills, 0) as kills, coalesce(assists, 0) as assists, coalesce(deaths, 0) as deaths, coalesce(damagedealt, 0) as damage_dealt, coalesce(healingdone, 0) as healing_done, coalesce(ubersused, 0) as ubers_used"
_METRIC = lambda m: f"try_cast(json_extract_string(metrics_json, '$.{m}') as double)"
_METRICS = ("auc", "roc_auc", "f1", "precision", "recall", "rmse", "mae")

PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "logs": ((), """select cast(o_orderkey as varchar) as recordid, o_orderkey as logid, 'match ' || o_orderkey as title, o_orderpriority as map, o_orderdate as match_time,
  cast(floor(o_totalprice) as bigint) % 3600 as durationseconds, redscore, bluescore, o_orderdate as __ingest_ts
  from orders left join (select l_orderkey, count(*) filter (l_linestatus = 'O') as redscore, count(*) filter (l_linestatus = 'F') as bluescore from lineitem group by 1) s on o_orderkey = l_orderkey"""),
    "summaries": ((), """select l_orderkey || ':' || l_linenumber as recordid, l_orderkey as logid, cast(l_suppkey as varchar) as steamid,
  case l_linestatus when 'O' then 'Red' when 'F' then 'Blue' end as team, o_orderpriority as map, o_orderdate as match_time, p_type || ', ' || p_brand as classesplayedcsv,
  cast(floor(l_quantity) as bigint) as kills, cast(floor(l_discount * 100 + 0.5) as bigint) as assists, cast(floor(l_quantity) as bigint) % 25 as deaths,
  cast(floor(l_extendedprice) as bigint) as damagedealt, cast(floor(l_tax * 1000 + 0.5) as bigint) as healingdone, cast(l_linenumber % 4 as bigint) as ubersused, l_partkey as partkey, l_shipdate as __ingest_ts
  from lineitem left join orders on l_orderkey = o_orderkey left join part on l_partkey = p_partkey"""),
    "messages": ((), """select conv_id || ':' || turn as recordid, conv_id as logid, turn as messageindex, cast(l_suppkey as varchar) as steamid, text as message, lower(text) as messagelower, l_shipdate as __ingest_ts
  from conversations join lineitem on conv_id = l_orderkey and turn + 1 = l_linenumber"""),
    "logs_base": (("logs",), "select * from logs qualify row_number() over (partition by logid order by __ingest_ts desc, recordid desc) = 1"),
    "summaries_one": (("summaries",), "select * from summaries qualify row_number() over (partition by recordid order by __ingest_ts desc, steamid desc, partkey desc, damagedealt desc, kills desc, assists desc, healingdone desc, team desc) = 1"),
    "summaries_base": (("summaries_one",), "select * from summaries_one where team in ('Red', 'Blue') qualify row_number() over (partition by logid, steamid order by __ingest_ts desc, recordid desc) = 1"),
    "messages_base": (("messages",), "select * from messages qualify row_number() over (partition by recordid order by __ingest_ts desc, steamid desc, message desc) = 1"),
    "shares": (("summaries_base",), f"""select s.*, {ratio('kills', 'tk')} as ks, {ratio('damagedealt', 'td')} as ds, {ratio('healingdone', 'th')} as hs,
  0.45::double * {ratio('damagedealt', 'td')} + 0.35::double * {ratio('kills', 'tk')} + 0.2::double * {ratio('healingdone', 'th')} as impact
  from summaries_base s join (select logid as tl, team as tt, sum(kills) as tk, sum(damagedealt) as td, sum(healingdone) as th from summaries_base group by 1, 2) t on logid = tl and team = tt"""),
    "chat": (("messages_base",), chat(False)),
    "chat_lower": (("messages_base",), chat(True)),
    "features_player_match": (("shares", "logs_base", "chat"), f"""select s.logid, s.steamid, s.map, s.team, s.match_time, cast(s.match_time as date) as match_date, coalesce(durationseconds, 0) as duration_seconds,
  kills, assists, deaths, damagedealt as damage_dealt, healingdone as healing_done, ubersused as ubers_used, coalesce(classesplayedcsv, '') as classes_played_csv,
  cast(len(list_filter(string_split(coalesce(classesplayedcsv, ''), ','), lambda c: trim(c) <> '')) as integer) as classes_played_count, {wins('s.team')} as won_game,
  {r('ks', 4)} as kill_share_of_team, {r('ds', 4)} as damage_share_of_team, {r('hs', 4)} as healing_share_of_team, {r('impact', 4)} as impact_index,
  {r(ratio('damagedealt', 'coalesce(durationseconds, 0) / 60.0::double'), 3)} as damage_per_minute, {r(_KDA, 3)} as kda_ratio,
  coalesce(chat_messages, 0) as chat_messages, {r('coalesce(avg_message_length, 0.0)', 3)} as avg_message_length, coalesce(all_caps_messages, 0) as all_caps_messages,
  coalesce(intense_punctuation_messages, 0) as intense_punctuation_messages, coalesce(negative_lexicon_hits, 0) as negative_lexicon_hits,
  coalesce({ratio('negative_lexicon_hits', 'chat_messages')}, 0.0::double) as negative_chat_ratio,
  case when deaths >= 12 and coalesce(chat_messages, 0) >= 2 and coalesce(negative_lexicon_hits, 0) >= 1 then 1 else 0 end as possible_tilt_label
  from shares s left join logs_base l on s.logid = l.logid left join chat c on s.logid = c.logid and s.steamid = c.steamid"""),
    "scored": (("features_player_match",), f"""select *, row_number() over (partition by steamid order by match_time, logid) as games_played_to_date, {last(5, 'kills')} as k5, {last(10, 'damage_dealt')} as d10,
  {last(10, 'impact_index')} as i10, {last(10, _KDA)} as a10, {last(10, 'won_game')} as w10, {last(10, 'negative_chat_ratio')} as n10,
  avg(kills) over (partition by steamid) as ck, avg(damage_dealt) over (partition by steamid) as cd, avg(impact_index) over (partition by steamid) as ci from features_player_match"""),
    "features_player_recent_form": (("scored",), f"""select steamid, logid, map, team, match_time, match_date, cast(games_played_to_date as integer) as games_played_to_date, kills, assists, deaths, damage_dealt, healing_done, impact_index,
  {r('negative_chat_ratio', 4)} as negative_chat_ratio, won_game, {r('k5', 3)} as rolling_5_avg_kills, {r('d10', 3)} as rolling_10_avg_damage, {r('i10', 4)} as rolling_10_avg_impact, {r('a10', 4)} as rolling_10_kda_ratio,
  {r('w10', 4)} as rolling_10_win_rate, {r('n10', 4)} as rolling_10_negative_chat_ratio, {r('ck', 3)} as career_avg_kills, {r('cd', 3)} as career_avg_damage, {r('ci', 4)} as career_avg_impact,
  {r('k5 - ck', 3)} as form_delta_kills, {r('d10 - cd', 3)} as form_delta_damage, {r('i10 - ci', 4)} as form_delta_impact,
  case when {r('i10 - ci', 9)} >= 0.016::double then 'hot' when {r('i10 - ci', 9)} <= -0.020::double then 'cold' else 'stable' end as momentum_label from scored"""),
    "serving_player_profiles": (("features_player_match", "features_player_recent_form"), f"""select c.*, {_FORM.replace('rolling', 'f.rolling').replace('form_', 'f.form_').replace('momentum', 'f.momentum')}, f.match_time as latest_match_time, recent_30_avg_kills, recent_30_avg_damage, recent_30_avg_impact, recent_30_win_rate from
  (select steamid, count(*) as games_played, count(distinct map) as maps_played, min(match_time) as first_seen_at, max(match_time) as last_seen_at, {r('avg(won_game)', 4)} as career_win_rate,
   {r(ratio('sum(kills)', 'sum(deaths)'), 4)} as career_kd_ratio, {r('avg(kda_ratio)', 4)} as career_avg_kda_ratio, {r('avg(kills)', 3)} as career_avg_kills, {r('avg(damage_dealt)', 3)} as career_avg_damage,
   {r('avg(damage_per_minute)', 3)} as career_avg_damage_per_minute, {r('avg(impact_index)', 4)} as career_avg_impact, {r('avg(possible_tilt_label)', 4)} as tilt_risk_rate from features_player_match group by steamid) c
  left join (select * from features_player_recent_form qualify row_number() over (partition by steamid order by match_time desc, logid desc) = 1) f on c.steamid = f.steamid
  left join (select steamid, {r('avg(kills)', 3)} as recent_30_avg_kills, {r('avg(damage_dealt)', 3)} as recent_30_avg_damage, {r('avg(impact_index)', 4)} as recent_30_avg_impact, {r('avg(won_game)', 4)} as recent_30_win_rate
   from (select * from features_player_match qualify row_number() over (partition by steamid order by match_time desc, logid desc) <= 30) x group by steamid) q on c.steamid = q.steamid"""),
    "game": (("logs_base", "summaries_base"), """select l.logid, l.map, cast(match_time as date) as match_date, coalesce(durationseconds, 0) as secs, abs(coalesce(redscore, 0) - coalesce(bluescore, 0)) as gap, coalesce(k, 0) as k
  from logs_base l left join (select logid, sum(kills) as k from summaries_base group by 1) s on l.logid = s.logid"""),
    "serving_map_overview_daily": (("game", "features_player_match"), f"""select g.*, coalesce(p, 0) as active_players, {r('coalesce(pi, 0.0)', 4)} as avg_player_impact_index, {r('coalesce(pn, 0.0)', 4)} as avg_negative_chat_ratio, {r('coalesce(pt, 0.0)', 4)} as tilt_signal_rate from
  (select map, match_date, count(distinct logid) as games, {r('avg(secs) / 60.0', 3)} as avg_duration_minutes, {r('avg(k)', 3)} as avg_total_kills, {r('avg(' + ratio('k', 'secs / 60.0::double') + ')', 3)} as avg_kills_per_minute,
   {r('avg(case when gap <= 1 then 1.0::double else 0.0 end)', 4)} as close_game_rate, {r('avg(case when gap >= 4 then 1.0::double else 0.0 end)', 4)} as blowout_rate from game group by 1, 2) g
  left join (select map, match_date, count(distinct steamid) as p, avg(impact_index) as pi, avg(negative_chat_ratio) as pn, avg(possible_tilt_label) as pt from features_player_match group by 1, 2) f on g.map = f.map and g.match_date = f.match_date"""),
    "serving_player_match_deep_dive": (("features_player_match", "features_player_recent_form"), f"""select m.* exclude (classes_played_csv, negative_chat_ratio), {r('m.negative_chat_ratio', 4)} as negative_chat_ratio, games_played_to_date, {_FORM},
  case when possible_tilt_label = 1 or m.negative_chat_ratio >= 0.18::double then 'high' when m.negative_chat_ratio >= 0.08::double then 'medium' else 'low' end as behaviour_risk_tier,
  case when coalesce(m.impact_index, 0) >= 0.24::double then 'elite' when coalesce(m.impact_index, 0) >= 0.18::double then 'strong' when coalesce(m.impact_index, 0) >= 0.13::double then 'average' else 'struggling' end as impact_tier
  from features_player_match m left join features_player_recent_form f on m.logid = f.logid and m.steamid = f.steamid"""),
    **{n: ((), plain_sql(n)) for n in INPUTS},
    "snapshot_meta": (("ml_training_dataset_snapshots",), "select snapshot_id, snapshot_cutoff_time, snapshot_cutoff_date, training_rows as snapshot_training_rows, created_at as snapshot_recorded_at from ml_training_dataset_snapshots qualify row_number() over (partition by snapshot_id order by created_at desc, training_rows desc) = 1"),
    "serving_ml_model_registry": (("ml_model_registry", "snapshot_meta"), f"""select m.* exclude (is_active), coalesce(is_active, false) as is_active, s.* exclude (snapshot_id), {', '.join(f'{_METRIC(m)} as metric_{m}' for m in _METRICS)},
  case {' '.join(f"when {_METRIC(m)} is not null then '{m}'" for m in _METRICS)} end as primary_metric_name, coalesce({', '.join(_METRIC(m) for m in _METRICS)}) as primary_metric_value,
  cast(date_diff('day', cast(coalesce(snapshot_cutoff_time, created_at) as date), {day(0)}) as integer) as data_age_days, cast(date_diff('day', cast(coalesce(promoted_at, created_at) as date), {day(0)}) as integer) as model_age_days
  from ml_model_registry m left join snapshot_meta s on m.snapshot_id = s.snapshot_id"""),
    "runs": (("ops_pipeline_runs",), "select *, cast(started_at as date) as d from ops_pipeline_runs where step_name = 'pipeline' or starts_with(step_name, 'pipeline_')"),
    "serving_ml_pipeline_progress_daily": (("runs", "ml_training_dataset_snapshots", "ml_model_registry", "ml_model_stage_history"), f"""select x.d as progress_date, coalesce(ok, 0) as pipeline_success_runs, coalesce(bad, 0) as pipeline_failed_runs, coalesce(secs, 0.0) as avg_pipeline_duration_seconds, coalesce(st, 'unknown') as latest_pipeline_status,
  coalesce(sn, 0) as snapshots_created, coalesce(sr, 0) as training_rows_materialised, sid as latest_snapshot_id, sc as latest_snapshot_created_at, coalesce(m, 0) as models_registered, coalesce(mc, 0) as candidate_models_registered, coalesce(ms, 0) as staging_models_registered,
  coalesce(mp, 0) as production_models_registered, coalesce(ps, 0) as promotions_to_staging, coalesce(pp, 0) as promotions_to_production, (select count(*) from ml_model_registry where stage = 'production' and is_active) as active_production_models from
  (select d from runs union select snapshot_cutoff_date from ml_training_dataset_snapshots union select cast(created_at as date) from ml_model_registry union select cast(changed_at as date) from ml_model_stage_history) x
  left join (select d, count(*) filter (status = 'success') as ok, count(*) filter (status = 'failed') as bad, {r('avg(duration_seconds)', 3)} as secs from runs group by d) a on x.d = a.d
  left join (select d, status as st from runs qualify row_number() over (partition by d order by started_at desc, run_id desc) = 1) b on x.d = b.d
  left join (select snapshot_cutoff_date as d, count(*) as sn, cast(sum(training_rows) as bigint) as sr, max(created_at) as sc from ml_training_dataset_snapshots group by 1) c on x.d = c.d
  left join (select snapshot_cutoff_date as d, snapshot_id as sid from ml_training_dataset_snapshots qualify row_number() over (partition by snapshot_cutoff_date order by created_at desc, snapshot_id desc) = 1) e on x.d = e.d
  left join (select cast(created_at as date) as d, count(*) as m, count(*) filter (stage = 'candidate') as mc, count(*) filter (stage = 'staging') as ms, count(*) filter (stage = 'production') as mp from ml_model_registry group by 1) f on x.d = f.d
  left join (select cast(changed_at as date) as d, count(*) filter (to_stage = 'staging') as ps, count(*) filter (to_stage = 'production') as pp from ml_model_stage_history group by 1) g on x.d = g.d"""),
    "serving_ml_prediction_quality_daily": (("ml_model_validation_metrics_daily", "ml_model_registry", "snapshot_meta"), f"""select q.* exclude (created_at), v.stage, coalesce(v.is_active, false) as is_active, s.snapshot_cutoff_date,
  cast(date_diff('day', cast(coalesce(snapshot_cutoff_time, q.created_at) as date), {day(0)}) as integer) as data_age_days from ml_model_validation_metrics_daily q
  left join (select * from ml_model_registry qualify row_number() over (partition by model_name, model_version order by created_at desc, snapshot_id desc) = 1) v on q.model_name = v.model_name and q.model_version = v.model_version
  left join snapshot_meta s on q.snapshot_id = s.snapshot_id"""),
    "target": (("serving_player_profiles",), "select steamid as who from serving_player_profiles order by last_seen_at desc, steamid limit 1"),
}
PARTS |= {n: (PARTS[n][0], f"select *, timestamp '{AS_OF} 00:00:00' as updated_at from ({PARTS[n][1]}) made") for n in STAMPED}


def compose(final: str, *needs: str) -> str:
    order: list[str] = []

    def add(n: str) -> None:
        for d in PARTS[n][0]:
            add(d)
        if n not in order:
            order.append(n)

    for n in needs:
        add(n)
    return "with " + ",\n".join(f"{n} as materialized ({PARTS[n][1]})" for n in order) + "\n" + final


def _profile(keep: str, who: str, last: str = "") -> str:
    at = lambda c: r(f"case when n <= 1 then 0.0::double else {ratio(f'{c} * 100.0', 'n - 1')} end", 1)
    return f"""select t.steamid{keep}, {at('a')} as impact_percentile, {at('b')} as win_rate_percentile, {at('c')} as tilt_risk_percentile{last} from (select * from serving_player_profiles where steamid = {who}) t,
  (select count(*) as n, count(*) filter (p.career_avg_impact < x.career_avg_impact) as a, count(*) filter (p.career_win_rate < x.career_win_rate) as b, count(*) filter (p.tilt_risk_rate < x.tilt_risk_rate) as c
   from serving_player_profiles p, (select * from serving_player_profiles where steamid = {who}) x) y"""


_PROFILE_KEEP = ", games_played, maps_played, first_seen_at, last_seen_at, career_win_rate, career_kd_ratio, career_avg_damage, career_avg_impact, rolling_10_avg_impact, form_delta_impact, momentum_label, rolling_10_negative_chat_ratio, tilt_risk_rate"
_MAPS14 = f"""select map, count(*) as days_observed, cast(sum(games) as bigint) as total_games, {r('avg(avg_negative_chat_ratio)', 4)} as avg_negative_chat_ratio, {r('max(avg_negative_chat_ratio)', 4)} as peak_negative_chat_ratio,
  {r('avg(tilt_signal_rate)', 4)} as avg_tilt_signal_rate, {r('max(tilt_signal_rate)', 4)} as peak_tilt_signal_rate from serving_map_overview_daily where match_date >= {day(14)} group by map having sum(games) >= 10"""
_W = lambda c: ratio(f"sum({c} * games)", "sum(games)")
_MAPS30 = f"""select map, count(*) as days_observed, cast(sum(games) as bigint) as total_games, cast(sum(active_players) as bigint) as total_active_players, {r('avg(avg_duration_minutes)', 3)} as avg_duration_minutes,
  {r('avg(avg_total_kills)', 3)} as avg_total_kills, {r('avg(avg_kills_per_minute)', 3)} as avg_kills_per_minute, {r(_W('close_game_rate'), 4)} as close_game_rate, {r(_W('blowout_rate'), 4)} as blowout_rate,
  {r(_W('close_game_rate') + ' - ' + _W('blowout_rate'), 4)} as competitiveness_index, {r('avg(avg_player_impact_index)', 4)} as avg_player_impact_index, {r('avg(avg_negative_chat_ratio)', 4)} as avg_negative_chat_ratio,
  {r('avg(tilt_signal_rate)', 4)} as tilt_signal_rate from serving_map_overview_daily where match_date >= {day(30)} group by map having sum(games) >= 10"""


def _same(scale: int, won: str) -> str:
    return f"""count(*) as shared_games, cast(sum(same) as bigint) as games_as_teammates, cast(sum(1 - same) as bigint) as games_as_opponents, {r('avg(same)', scale)} as same_team_rate,
  {r(f'avg(case when same = 1 then {won} end)', scale)} as win_rate_when_teammates"""


def _non_empty(name: str, table: str, text: str) -> str:
    return f"select '{name}_non_empty' as check_name, case when count(*) > 0 then 'PASS' else 'FAIL' end as status, count(*)::double as metric_value, '> 0 rows' as threshold, '{text}' as details from {table}"


def _zero(name: str, table: str, text: str) -> str:
    return f"select '{name}', case when count(*) = 0 then 'PASS' else 'FAIL' end, count(*)::double, '= 0 rows', '{text}' from {table}"


def _age(name: str, table: str, text: str) -> str:
    d = f"date_diff('day', max(match_date), {day(0)})"
    return f"select '{name}', case when {d} <= 2 then 'PASS' else 'FAIL' end, ({d})::double, '<= 2 days', '{text}' from {table}"


def _twice(table: str) -> str:
    return f"(select logid, steamid from {table} group by 1, 2 having count(*) > 1) x"


_SERVING = [
    _non_empty("serving_player_profiles", "serving_player_profiles", "player profile serving table must contain rows"),
    _non_empty("serving_map_overview_daily", "serving_map_overview_daily", "map overview serving table must contain rows"),
    _non_empty("serving_player_match_deep_dive", "serving_player_match_deep_dive", "player match deep-dive serving table must contain rows"),
    _age("serving_player_match_deep_dive_freshness_days", "serving_player_match_deep_dive", "serving deep-dive table should be refreshed recently"),
    "select 'serving_vs_features_row_coverage', case when f > 0 and s / f >= 0.98 then 'PASS' else 'FAIL' end, case when f = 0 then 0.0 else s / f end, '>= 0.98 ratio', 'serving deep-dive coverage should stay close to feature row count' from (select (select count(*) from features_player_match)::double as f, (select count(*) from serving_player_match_deep_dive)::double as s) x",
    _zero("serving_player_profiles_null_keys", "serving_player_profiles where steamid is null", "serving player rows must have steamid"),
    _zero("serving_map_overview_daily_null_keys", "serving_map_overview_daily where map is null or match_date is null", "serving map rows must have map and match_date"),
    _zero("serving_player_match_deep_dive_null_keys", "serving_player_match_deep_dive where steamid is null or logid is null or match_date is null", "deep-dive serving rows must have logid, steamid, and match_date"),
    _zero("serving_player_match_deep_dive_duplicate_keys", _twice("serving_player_match_deep_dive"), "deep-dive serving table must have one row per (logid, steamid)"),
    _zero("serving_ml_model_registry_null_keys", "serving_ml_model_registry where model_name is null or model_version is null", "ml model registry serving rows must have model identifiers"),
    _zero("serving_ml_pipeline_progress_null_keys", "serving_ml_pipeline_progress_daily where progress_date is null", "ml pipeline progress rows must have progress_date"),
    _zero("serving_ml_prediction_quality_null_keys", "serving_ml_prediction_quality_daily where model_name is null or model_version is null or progress_date is null", "prediction quality rows must have model identifiers and progress_date"),
]
_FEATURES = [
    _non_empty("core_logs", "logs", "core logs table must not be empty"),
    _non_empty("features_player_match", "features_player_match", "feature table must contain match rows"),
    _non_empty("features_player_recent_form", "features_player_recent_form", "rolling form table must contain rows"),
    _age("features_player_match_freshness_days", "features_player_match", "features match table should be refreshed recently"),
    _zero("features_player_match_null_keys", "features_player_match where steamid is null or logid is null", "feature rows must have logid and steamid"),
    _zero("features_player_match_duplicate_keys", _twice("features_player_match"), "feature table must have one row per (logid, steamid)"),
    _zero("features_recent_form_orphans", "features_player_recent_form f anti join features_player_match m on f.logid = m.logid and f.steamid = m.steamid", "recent-form rows must map to feature rows"),
    f"select 'tilt_label_recent_drift_abs_delta', case when abs(a - b) <= 0.05 then 'PASS' else 'FAIL' end, {r('abs(a - b)', 9)}, '<= 0.05 absolute delta', 'tilt signal drift should remain within expected bounds' from (select avg(possible_tilt_label) filter (match_date >= {day(7)}) as a, avg(possible_tilt_label) filter (match_date >= {day(35)} and match_date < {day(7)}) as b from features_player_match) x",
]


def _ready(name: str, value: str, op: str, table: str, text: str, threshold: str) -> str:
    return f"select '{name}' as check_name, case when {value} {op} then 'PASS' else 'FAIL' end as status, ({value})::double as metric_value, '{threshold}' as threshold, '{text}' as details from {table}"


def _rate(cond: str) -> str:
    return r(f"avg(case when {cond} then 1.0::double else 0.0 end)", 6)


_M = "features_player_match"
_READY = [
    _ready("feature_rows_minimum", "count(*)", ">= 10000", _M, "enough feature rows for baseline modelling", ">= 10000 rows"),
    _ready("distinct_players_minimum", "count(distinct steamid)", ">= 1000", _M, "enough unique players for generalisable training", ">= 1000 players"),
    _ready("distinct_days_minimum", "count(distinct match_date)", ">= 7", _M, "minimum temporal coverage for time-aware validation", ">= 7 match days"),
    _ready("map_diversity_minimum", "count(distinct map)", ">= 50", _M, "enough map diversity to reduce map-specific overfit", ">= 50 maps"),
    _ready("impact_null_rate", _rate("impact_index is null"), "<= 0.05", _M, "impact feature missingness should stay low", "<= 0.05"),
    _ready("kda_null_rate", _rate("kda_ratio is null"), "<= 0.05", _M, "KDA missingness should stay low", "<= 0.05"),
    _ready("negative_chat_signal_rate", _rate("negative_lexicon_hits > 0"), ">= 0.005", _M, "toxicity model needs non-zero negative-chat signal rows", ">= 0.005"),
    _ready("tilt_label_rate_non_zero", r("avg(possible_tilt_label)", 6), ">= 0.005", _M, "tilt label must have enough positive examples", ">= 0.005"),
    _ready("recent_form_join_coverage", _rate("f.logid is not null"), ">= 0.995", f"{_M} m left join features_player_recent_form f on m.logid = f.logid and m.steamid = f.steamid", "recent-form features should exist for almost all match rows", ">= 0.995"),
    _ready("players_with_20_games_rate", _rate("n >= 20"), ">= 0.2", f"(select count(*) as n from {_M} group by steamid) x", "history-heavy models need enough players with stable history", ">= 0.20"),
    _ready("snapshot_exists", "count(*)", "> 0", "ml_training_dataset_snapshots", "at least one immutable training snapshot should be materialised", "> 0 snapshots"),
    _ready("snapshot_freshness_days", f"date_diff('day', max(snapshot_cutoff_date), {day(0)})", "<= 2", "ml_training_dataset_snapshots", "latest training snapshot should stay reasonably fresh", "<= 2 days"),
]
_DPM, _ODPM = ratio("d", "s / 60.0::double"), ratio("od", "os / 60.0::double")

SQL: dict[str, str] = {
    "q01_class_usage": compose(f"""select t.steamid, n as total_games, coalesce(u, 0) as unique_classes, c as primary_class, cn as primary_class_games, {r(ratio('coalesce(u, 0)', 'n'), 3)} as class_diversity_index, {r(ratio('coalesce(cn, 0)', 'n'), 3)} as primary_class_share
  from (select steamid, count(*) as n from summaries_base group by 1 having count(*) >= 25) t
  left join (select steamid, c, cn, count(*) over (partition by steamid) as u from (select steamid, lower(trim(c)) as c, count(distinct logid) as cn from (select steamid, logid, unnest(string_split(coalesce(classesplayedcsv, ''), ',')) as c from summaries_base) x where trim(c) <> '' group by 1, 2) y
    qualify row_number() over (partition by steamid order by cn desc, c desc) = 1) p on t.steamid = p.steamid order by class_diversity_index desc, total_games desc, t.steamid limit 300""", "summaries_base"),
    "q02_game_pace": compose(f"""select map, count(*) as games, {r('avg(secs) / 60.0', 2)} as avg_duration_minutes, {r('avg(k)', 2)} as avg_total_kills, {r('avg(' + ratio('k', 'secs / 60.0::double') + ')', 2)} as avg_kills_per_minute, {r('avg(gap)', 2)} as avg_score_delta,
  {r('avg(case when gap <= 1 then 1.0::double else 0.0 end)', 3)} as close_game_rate, {r('avg(case when gap >= 4 then 1.0::double else 0.0 end)', 3)} as blowout_rate from game group by map having count(*) >= 20""", "game"),
    "q03_head_to_head": compose(f"""select '{ONE}' as player_1_steam_id, '{TWO}' as player_2_steam_id, count(*) as games_in_same_log, count(*) filter (a.team = b.team) as same_team_games, count(*) filter (a.team <> b.team) as opposing_team_games,
  coalesce(cast(sum({wins('a.team')}) as bigint), 0) as player_1_wins, coalesce(cast(sum({wins('b.team')}) as bigint), 0) as player_2_wins, {r('avg(a.kills)', 2)} as player_1_avg_kills, {r('avg(b.kills)', 2)} as player_2_avg_kills, {r('avg(a.damagedealt)', 2)} as player_1_avg_damage,
  {r('avg(b.damagedealt)', 2)} as player_2_avg_damage, {r(ratio('sum(a.kills + a.assists)', 'sum(a.deaths)'), 3)} as player_1_kda_ratio, {r(ratio('sum(b.kills + b.assists)', 'sum(b.deaths)'), 3)} as player_2_kda_ratio
  from (select * from summaries_base where steamid = '{ONE}') a join (select * from summaries_base where steamid = '{TWO}') b on a.logid = b.logid left join logs_base l on a.logid = l.logid""", "summaries_base", "logs_base"),
    "q04_match_breakdown": compose(f"""select l.logid, l.title, l.map, l.match_time, durationseconds, redscore, bluescore, steamid, team, {_MEASURES}, classesplayedcsv, {r('ks', 3)} as kill_share_of_team, {r('ds', 3)} as damage_share_of_team, {r('hs', 3)} as healing_share_of_team
  from logs_base l join shares s on l.logid = s.logid where l.logid = {MATCH}""", "logs_base", "shares"),
    "q05_map_specialists": compose(f"""select m.steamid, map, n as games_on_map, "on" as games_overall, {r(ratio('d', 'n'), 2)} as avg_damage_on_map, {r(ratio('od', '"on"'), 2)} as avg_damage_overall, {r(ratio('k', 'n'), 2)} as avg_kills_on_map, {r(ratio('ok', '"on"'), 2)} as avg_kills_overall,
  {r(ratio('k', 'x'), 3)} as kd_on_map, {r(ratio('ok', 'ox'), 3)} as kd_overall, {r(_DPM, 2)} as dpm_on_map, {r(_ODPM, 2)} as dpm_overall, {r(f'{_DPM} - {_ODPM}', 2)} as dpm_uplift, {r(ratio('k', 'x') + ' - ' + ratio('ok', 'ox'), 3)} as kd_uplift, {r(f'({_DPM} - {_ODPM}) * ln(1.0::double + n)', 3)} as specialist_score
  from (select s.steamid, s.map, count(*) as n, sum(damagedealt) as d, sum(kills) as k, sum(deaths) as x, sum(coalesce(durationseconds, 0)) as s from summaries_base s left join logs_base l on s.logid = l.logid group by 1, 2 having count(*) >= 8) m
  join (select s.steamid, count(*) as "on", sum(damagedealt) as od, sum(kills) as ok, sum(deaths) as ox, sum(coalesce(durationseconds, 0)) as os from summaries_base s left join logs_base l on s.logid = l.logid group by 1 having count(*) >= 30) o on m.steamid = o.steamid
  order by specialist_score desc nulls last, m.steamid, map limit 300""", "summaries_base", "logs_base"),
    "q06_activity_baseline": compose(f"""select steamid, count(*) as games_played, count(distinct s.map) as maps_played, count(distinct cast(s.match_time as date)) as active_days, min(s.match_time) as first_seen_at, max(s.match_time) as last_seen_at,
  {', '.join(f'cast(sum({c}) as bigint) as total_{n}' for c, n in (('kills', 'kills'), ('assists', 'assists'), ('deaths', 'deaths'), ('damagedealt', 'damage_dealt'), ('healingdone', 'healing_done'), ('ubersused', 'ubers_used')))},
  {r(ratio('sum(kills)', 'sum(deaths)'), 3)} as kd_ratio, {r(ratio('sum(kills) + sum(assists)', 'sum(deaths)'), 3)} as kda_ratio, {r('avg(kills)', 2)} as avg_kills_per_game, {r('avg(damagedealt)', 2)} as avg_damage_per_game,
  {r(ratio('sum(damagedealt)', 'sum(coalesce(durationseconds, 0)) / 60.0::double'), 2)} as damage_per_minute, {r(f'avg({wins()})', 3)} as win_rate from summaries_base s left join logs_base l on s.logid = l.logid group by steamid having count(*) >= 20""", "summaries_base", "logs_base"),
    "q07_coplay_network": compose(f"""select '{ONE}' as target_steam_id, other_steam_id, {_same(3, 'won')} from (select o.steamid as other_steam_id, case when o.team = a.team then 1 else 0 end as same, {wins('a.team')} as won
  from (select * from summaries_base where steamid = '{ONE}') a join summaries_base o on a.logid = o.logid and o.steamid <> a.steamid left join logs_base l on a.logid = l.logid) x group by other_steam_id having count(*) >= 5
  order by shared_games desc, same_team_rate desc, other_steam_id limit 300""", "summaries_base", "logs_base"),
    "q08_form_and_momentum": compose(f"""select steamid, logid, map, match_time, cast(row_number() over w as integer) as game_number, kills, assists, deaths, damagedealt as damage_dealt, healingdone as healing_done, {r('avg(kills) over l', 2)} as rolling_avg_kills, {r('avg(damagedealt) over l', 2)} as rolling_avg_damage,
  {r(f'avg({_KDA}) over l', 3)} as rolling_kda_ratio, {r(ratio('kills - avg(kills) over ()', 'stddev_pop(kills) over ()'), 3)} as kills_zscore_vs_career from summaries_base where steamid = '{ONE}'
  window w as (order by match_time, logid), l as (order by match_time, logid rows between 11 preceding and current row) order by match_time desc, logid desc limit 200""", "summaries_base"),
    "q09_pair_synergy": compose(f"""select a.steamid as player_a, b.steamid as player_b, count(*) as games_together, {r('avg(a.kills + b.kills)', 2)} as avg_combined_kills, {r('avg(a.damagedealt + b.damagedealt)', 2)} as avg_combined_damage, {r(ratio('sum(a.kills + b.kills)', 'sum(a.deaths + b.deaths)'), 3)} as combined_kd_ratio,
  {r(f"avg({wins('a.team')})", 3)} as win_rate_together, {r(f"avg(a.damagedealt + b.damagedealt) * avg({wins('a.team')}) / 1000.0", 4)} as synergy_score from summaries_base a join summaries_base b on a.logid = b.logid and a.team = b.team and a.steamid < b.steamid left join logs_base l on a.logid = l.logid
  group by 1, 2 having count(*) >= 20 order by synergy_score desc, games_together desc, player_a, player_b limit 200""", "summaries_base", "logs_base"),
    "q10_relative_impact": compose(f"""select steamid, logid, map, team, match_time, {_MEASURES}, {r('ks', 3)} as kill_share_of_team, {r('ds', 3)} as damage_share_of_team, {r('hs', 3)} as healing_share_of_team, {r('impact', 4)} as weighted_impact_index
  from shares where steamid = '{ONE}' order by match_time desc, logid desc limit 200""", "shares"),
    "q11_sentiment_export": compose(f"""select s.steamid, s.logid, s.match_time, s.map, s.team, {_MEASURES}, coalesce(classesplayedcsv, '') as classes_played_csv, coalesce(chat_messages, 0) as chat_messages, {r('coalesce(avg_message_length, 0.0)', 2)} as avg_message_length, coalesce(all_caps_messages, 0) as all_caps_messages,
  coalesce(intense_punctuation_messages, 0) as intense_punctuation_messages, coalesce(negative_lexicon_hits, 0) as negative_lexicon_hits, {wins('s.team')} as won_game, coalesce({ratio('negative_lexicon_hits', 'chat_messages')}, 0.0::double) as negative_chat_ratio,
  case when deaths >= 20 and coalesce(negative_lexicon_hits, 0) >= 2 then 1 else 0 end as possible_tilt_label from summaries_base s left join chat_lower c on s.logid = c.logid and s.steamid = c.steamid left join logs_base l on s.logid = l.logid""", "summaries_base", "chat_lower", "logs_base"),
    "q12_chat_cohorts": compose(f"""select momentum_label, count(*) as players, count(*) filter (tilt_risk_rate >= 0.12::double or rolling_10_negative_chat_ratio >= 0.08::double) as high_risk_players, {r(ratio('count(*) filter (tilt_risk_rate >= 0.12::double or rolling_10_negative_chat_ratio >= 0.08::double)', 'count(*)'), 4)} as high_risk_player_rate,
  {r('avg(tilt_risk_rate)', 4)} as avg_tilt_risk_rate, {r('avg(rolling_10_negative_chat_ratio)', 4)} as avg_rolling_negative_chat_ratio from serving_player_profiles group by 1""", "serving_player_profiles"),
    "q13_tilt_hotspots": compose(_MAPS14, "serving_map_overview_daily"),
    "q14_map_competitiveness": compose(_MAPS30, "serving_map_overview_daily"),
    "q15_tilt_anomalies": compose(f"""select map, cast(g as bigint) as recent_games, {r('rn', 4)} as recent_negative_chat_ratio, {r('rt', 4)} as recent_tilt_signal_rate, {r('bn', 4)} as baseline_negative_chat_ratio, {r('bt', 4)} as baseline_tilt_signal_rate, {r(ratio('rn - bn', 'sn'), 4)} as negative_chat_zscore, {r(ratio('rt - bt', 'st'), 4)} as tilt_signal_zscore
  from (select map, sum(games) filter (match_date >= {day(14)}) as g, avg(avg_negative_chat_ratio) filter (match_date >= {day(14)}) as rn, avg(tilt_signal_rate) filter (match_date >= {day(14)}) as rt, avg(avg_negative_chat_ratio) as bn, avg(tilt_signal_rate) as bt,
   {r('stddev_pop(avg_negative_chat_ratio)', 12)} as sn, {r('stddev_pop(tilt_signal_rate)', 12)} as st from serving_map_overview_daily where match_date >= {day(90)} group by map) x where g >= 15""", "serving_map_overview_daily"),
    "q16_quality_trend": compose(f"select * exclude (snapshot_id, snapshot_cutoff_date) from serving_ml_prediction_quality_daily where progress_date >= {day(90)}", "serving_ml_prediction_quality_daily"),
    "q17_quality_latest": compose("""select model_name, model_version, task_type, stage, is_active, snapshot_id, progress_date, rows_total, precision, recall, f1, roc_auc, pr_auc,
  brier, rmse, mae, data_age_days, updated_at from serving_ml_prediction_quality_daily
  qualify rank() over (partition by model_name, model_version order by progress_date desc) = 1""", "serving_ml_prediction_quality_daily"),
    "q18_ml_progress": compose(f"select * exclude (latest_snapshot_created_at) from serving_ml_pipeline_progress_daily where progress_date >= {day(90)}", "serving_ml_pipeline_progress_daily"),
    "q19_registry_snapshot": compose(f"""select model_name, model_version, task_type, stage, is_active, snapshot_id, snapshot_cutoff_date, snapshot_training_rows,
  primary_metric_name, {r('primary_metric_value', 6)} as primary_metric_value, metric_auc, metric_precision, metric_recall, metric_f1, metric_rmse, metric_mae,
  model_age_days, data_age_days, created_at, promoted_at, updated_at from serving_ml_model_registry""", "serving_ml_model_registry"),
    "q20_player_deep_dive": compose(f"""select map, count(*) as games, {r('avg(won_game)', 4)} as win_rate, {r('avg(kills)', 3)} as avg_kills, {r('avg(damage_dealt)', 3)} as avg_damage, {r('avg(impact_index)', 4)} as avg_impact_index, {r('avg(kda_ratio)', 3)} as avg_kda_ratio, {r('avg(negative_chat_ratio)', 4)} as avg_negative_chat_ratio,
  {r(ratio("count(*) filter (behaviour_risk_tier = 'high')", 'count(*)'), 4)} as high_risk_game_rate, {r(ratio("count(*) filter (impact_tier in ('elite', 'strong'))", 'count(*)'), 4)} as strong_impact_game_rate, {r(ratio("count(*) filter (momentum_label = 'hot')", 'count(*)'), 4)} as hot_momentum_game_rate
  from serving_player_match_deep_dive, target where steamid = who and match_date >= {day(60)} group by map having count(*) >= 5""", "serving_player_match_deep_dive", "target"),
    "q21_profile_percentiles": compose(_profile(_PROFILE_KEEP, "(select who from target)", ", t.updated_at"), "target"),
    "q22_synergy_network": compose(f"""select who as target_steamid, other_steamid, {_same(4, 'won')}, {r('avg(oi)', 4)} as avg_other_impact_index, {r("avg(case when tier = 'high' then 1.0::double else 0.0 end)", 4)} as high_risk_pair_rate
  from (select who, o.steamid as other_steamid, case when o.team = a.team then 1 else 0 end as same, case when a.won_game = 1 then 1 else 0 end as won, o.impact_index as oi, o.behaviour_risk_tier as tier
   from (select d.*, who from serving_player_match_deep_dive d, target where steamid = who and match_date >= {day(90)}) a join serving_player_match_deep_dive o on a.logid = o.logid and o.steamid <> a.steamid) x group by 1, 2 having count(*) >= 5""", "serving_player_match_deep_dive", "target"),
    "q23_platform_checks": compose(" union all ".join(_FEATURES + _SERVING), "logs", *PUBLISHED),
    "q24_serving_checks": compose(" union all ".join(_SERVING), *PUBLISHED),
    "q25_readiness_checks": compose(" union all ".join(_READY), "features_player_match", "features_player_recent_form", "ml_training_dataset_snapshots"),
    "q26_f1_stability": compose(f"select count(distinct progress_date) as days, {r('coalesce(stddev_samp(f1), 0.0)', 9)} as f1_stddev from ml_model_validation_metrics_daily where model_name = 'tilt_risk_baseline' and model_version = 'v2' and f1 is not null", "ml_model_validation_metrics_daily"),
    "q27_1_profile_lookup": compose(_profile("", f"'{ONE}'"), "serving_player_profiles"),
    "q27_2_map_rollup": compose(_MAPS30, "serving_map_overview_daily"),
    "q27_3_hotspot_rollup": compose(_MAPS14, "serving_map_overview_daily"),
    "q28_recent_runs": compose("select run_id, run_mode, step_name, status, started_at, duration_seconds from ops_pipeline_runs order by started_at desc, run_id limit 50", "ops_pipeline_runs"),
    **{f"t_{n}": compose(f"select * from {n}", n) for n in PUBLISHED if n not in ("logs_base", "summaries_base", "messages_base")},
    "t_ml_training_player_match": compose("""select 'train_' || cast(epoch(c) as bigint) as snapshot_id, c as snapshot_cutoff_time, cast(c as date) as snapshot_cutoff_date,
  m.* exclude (won_game, possible_tilt_label, classes_played_csv), f.games_played_to_date, f.career_avg_kills, f.career_avg_damage, f.career_avg_impact, """ + ", ".join("f." + x.strip() for x in _FORM.split(",")) + """,
  cast(coalesce(case m.team when 'Red' then redscore else bluescore end, 0) as bigint) as team_score, cast(coalesce(case m.team when 'Red' then bluescore else redscore end, 0) as bigint) as opponent_score,
  cast(case m.team when 'Red' then coalesce(redscore, 0) - coalesce(bluescore, 0) else coalesce(bluescore, 0) - coalesce(redscore, 0) end as bigint) as score_delta, m.won_game as label_win,
  cast(ntile(100) over (partition by m.match_date order by m.impact_index asc nulls first, m.logid, m.steamid) as integer) as label_impact_percentile, m.possible_tilt_label as label_tilt
  from features_player_match m left join logs_base l on m.logid = l.logid left join features_player_recent_form f on m.logid = f.logid and m.steamid = f.steamid, (select max(match_time) as c from features_player_match) x where m.match_time <= c""", "features_player_match", "features_player_recent_form", "logs_base"),
    **{f"c_{n}": compose(chart_sql(s, AS_OF, r), s.table) for n, s in CHARTS.items() if not isinstance(s, Rows)},
}

# Columns and limits of the charts of plain rows.
SQL |= {
    "c_momentum_snapshot": compose("""select steamid, games_played, career_win_rate, career_avg_impact, rolling_10_avg_impact, form_delta_impact, momentum_label,
  tilt_risk_rate, rolling_10_negative_chat_ratio, updated_at from serving_player_profiles order by steamid limit 100""", "serving_player_profiles"),
    "c_impact_vs_tilt": compose("""select steamid, momentum_label, games_played, career_avg_impact, tilt_risk_rate from serving_player_profiles
  order by steamid limit 150""", "serving_player_profiles"),
    "c_map_snapshot": compose("""select match_date, map, games, avg_duration_minutes, avg_kills_per_minute, close_game_rate, blowout_rate, active_players,
  avg_negative_chat_ratio, tilt_signal_rate from serving_map_overview_daily order by match_date nulls first, map nulls first limit 200""", "serving_map_overview_daily"),
    "c_tilt_snapshot": compose("""select steamid, momentum_label, rolling_10_negative_chat_ratio, tilt_risk_rate, recent_30_win_rate, form_delta_impact
  from serving_player_profiles order by steamid limit 120""", "serving_player_profiles"),
    "c_chat_snapshot": compose("""select match_date, map, games, avg_negative_chat_ratio, tilt_signal_rate, active_players from serving_map_overview_daily
  order by match_date nulls first, map nulls first limit 120""", "serving_map_overview_daily"),
    "c_hotspots": compose("""select match_date, map, games, avg_negative_chat_ratio, tilt_signal_rate from serving_map_overview_daily
  order by match_date nulls first, map nulls first limit 300""", "serving_map_overview_daily"),
    "c_deep_dive_rows": compose("""select match_date, steamid, logid, map, won_game, kills, damage_dealt, impact_index, kda_ratio, negative_chat_ratio,
  momentum_label, behaviour_risk_tier, impact_tier from serving_player_match_deep_dive
  order by match_time nulls first, logid nulls first, steamid nulls first limit 250""", "serving_player_match_deep_dive"),
    "c_progress_rows": compose("""select progress_date, pipeline_success_runs, pipeline_failed_runs, avg_pipeline_duration_seconds, latest_pipeline_status, snapshots_created,
  training_rows_materialised, latest_snapshot_id, models_registered, promotions_to_production, active_production_models
  from serving_ml_pipeline_progress_daily order by progress_date nulls first limit 200""", "serving_ml_pipeline_progress_daily"),
    "c_registry_rows": compose("""select model_name, model_version, task_type, stage, is_active, snapshot_id, primary_metric_name, primary_metric_value,
  model_age_days, data_age_days from serving_ml_model_registry order by model_name nulls first, model_version nulls first limit 300""", "serving_ml_model_registry"),
    "c_quality_rows": compose("""select progress_date, model_name, model_version, task_type, stage, is_active, rows_total, precision, recall, f1, roc_auc, pr_auc,
  brier, rmse, mae, data_age_days from serving_ml_prediction_quality_daily
  order by progress_date nulls first, model_name nulls first, model_version nulls first, snapshot_id nulls first, rows_total nulls first limit 300""", "serving_ml_prediction_quality_daily"),
}


def varied(name: str) -> str:
    """A query's SQL with the words of the synthetic chat and, where it has them, other limits."""
    sql = SQL[name].replace(whole_words(FEATURE_LEXICON), LEXICON).replace(whole_words(EXPLORATION_LEXICON), LEXICON)
    for old, new in {
        "q09_pair_synergy": (("having count(*) >= 20 order", "having count(*) >= 5 order"),),
        "q20_player_deep_dive": ((day(60), day(365)),),
        "q22_synergy_network": ((day(90), day(3650)), ("x group by 1, 2 having count(*) >= 5", "x group by 1, 2 having count(*) >= 2")),
    }.get(name, ()):
        if old not in sql:
            raise ValueError(f"{name} has no {old!r}")
        sql = sql.replace(old, new)
    return sql


SQL |= {f"x_{name}": varied(name) for name in VARIED}
