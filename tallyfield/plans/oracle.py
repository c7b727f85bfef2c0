"""The registered queries in DuckDB SQL, written from the league's definition."""

from __future__ import annotations

from ..sources.league import DIGITS, STATS

_ODDS = "case when ({x}) % 41 = 0 then null when ({x}) % 2 = 0 then 100 + ({x}) % 300 else -(100 + ({x}) % 300) end::double"
_R = "(12 * (year(o_orderdate) - 1995) + month(o_orderdate) - 1)"
_ID = "printf('%d_%02d_%02d_%02d', 1995 + r // 12, r % 12 + 1, away_key, home_key)"

BASE = f"""
with recursive tp as (select c_nationkey k, {_R} r, sum(round(o_totalprice * 100)::bigint)::bigint c from orders join customer on o_custkey = c_custkey group by 1, 2),
pairs as (
  select r, case when r % 2 = 0 then i else j end home_key, case when r % 2 = 0 then j else i end away_key
  from (select n_nationkey::bigint i, r::bigint r, ((r - n_nationkey) % 25 + 25) % 25 j from nation, range(80) t(r)) where i < j),
named as (select p.*, h.n_name home_team, a.n_name away_team from pairs p join nation h on h.n_nationkey = home_key join nation a on a.n_nationkey = away_key),
raw as (select n.*, h.c hc, a.c ac from named n left join tp h on h.k = home_key and h.r = n.r left join tp a on a.k = away_key and a.r = n.r),
games as (
  select {_ID} game_id, (1995 + r // 12)::int as season, (r % 12 + 1)::int as week, dense_rank() over (order by r)::int as week_seq,
    case when r % 12 + 1 <= 10 then 'REG' else 'WC' end game_type, case when r % 12 + 1 <= 10 then 'REG' else 'POST' end season_type,
    (make_date((1995 + r // 12)::int, (r % 12 + 1)::int, 1) + (home_key % 28)::int)::date gameday,
    case when hc % 53 = 0 then null when hc is not null and ac is not null then printf('%02d:%02d', 10 + hc % 12, ac % 60) end gametime,
    case when (home_key * away_key + r) % 11 = 0 then 'Neutral' else 'Home' end location, home_team, away_team,
    case when r < 78 then hc % 45 end::double home_score, case when r < 78 then ac % 45 end::double away_score,
    case when r < 78 then hc % 45 - ac % 45 end::double result, case when r < 78 then hc % 45 + ac % 45 end::double total,
    (hc % 29 - 14) / 2.0::double spread_line, 30 + (ac % 41) / 2.0::double total_line,
    {_ODDS.format(x="hc")} home_spread_odds, {_ODDS.format(x="ac")} away_spread_odds, {_ODDS.format(x="hc + 7")} under_odds,
    {_ODDS.format(x="ac + 7")} over_odds, {_ODDS.format(x="hc + 13")} home_moneyline, {_ODDS.format(x="ac + 13")} away_moneyline
  from raw),
long as (
  select game_id, season, week, week_seq, gameday, home_team team, away_team opponent, case when location = 'Neutral' then 'neutral' else 'home' end location, 1 loc,
    home_score team_score, away_score opponent_score, result, spread_line, total, season_type, case when result <> 0 then result > 0 end winner from games
  union all
  select game_id, season, week, week_seq, gameday, away_team, home_team, case when location = 'Neutral' then 'neutral' else 'away' end, 2,
    away_score, home_score, -result, -spread_line, total, season_type, case when result <> 0 then result < 0 end from games),
sides as (select r, home_key, away_key, home_team, away_team, home_key k, home_team pos, away_team def from named union all select r, home_key, away_key, home_team, away_team, away_key, away_team, home_team from named),
li as (select l.*, round(l_extendedprice * 100)::bigint px, round(l_tax * 100)::bigint tx, {_R} lr, c_nationkey lk from lineitem l join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey),
plays as (
  select {_ID} game_id, (1995 + s.r // 12)::int as season, (s.r % 12 + 1)::int as week, pos posteam, def defteam, home_team, away_team,
    case when px % 101 <> 0 then (px % 1001 - 500) / 100.0::double end epa, case when px % 97 <> 0 then (px % 700) / 100.0::double end ep,
    case when px % 89 <> 0 then (px % 101) / 100.0::double end vegas_wp, l_quantity <= 40 play, l_quantity > 40 special, l_returnflag = 'A' pass, l_returnflag = 'N' rush, tx >= 7 penalty,
    case when px % 83 = 0 then null when l_quantity > 45 then 'field_goal' when l_quantity > 40 then 'kickoff' when l_returnflag = 'A' then 'pass' when l_returnflag = 'N' then 'run' else 'no_play' end play_type,
    l_orderkey drive, case l_orderkey % 4 when 0 then 'Touchdown' when 1 then 'Field goal' when 2 then 'Punt' else 'Turnover' end drive_result,
    case when l_orderkey % 29 <> 0 then l_orderkey % 3 = 0 end inside20, l_returnflag = 'R' and px % 17 = 0 interception, l_returnflag = 'R' and px % 23 = 0 fumble_lost,
    px % 31 = 0 two_att, px % 31 = 0 and px % 2 = 0 two_made, px % 211 = 0 two_def, l_orderkey % 5 < 3 ok, ((l_linenumber - 1) % 4 + 1)::int as down
  from li join sides s on s.r = lr and s.k = lk),
stats as (select (1995 + r // 12)::int as season, (r % 12 + 1)::int as week, n_name team, {", ".join(f"({d.replace(' div ', ' // ')})::int as {c}" for c, d in zip(STATS, DIGITS))}
  from (select k, r, c t from tp) join nation on n_nationkey = k where r between 0 and 79)
"""


def _epa(side: str, value: str = "epa") -> str:
    team = "posteam" if side == "off" else "defteam"
    masks = {
        "total": "play or coalesce(play_type = 'field_goal', false)", "pass": "play and pass and not penalty", "rush": "play and rush and not penalty",
        "penalty": "play and penalty", "kick": "play_type = 'field_goal'", "special": "special and play_type <> 'field_goal'",
    }
    cols = ", ".join(
        f"count(*) filter (where {m}) {side}_{n}_plays, round(coalesce(sum({value}) filter (where {m}), 0) + 1e-9::double, 6) {side}_{n}_epa_sum, round(coalesce(avg({value}) filter (where {m}), 0) + 1e-9::double, 6) {side}_{n}_epa_mean"
        for n, m in masks.items()
    )
    return f"select game_id, season, week, {team} team, home_team, away_team, {cols} from plays where epa is not null and ep is not null group by all"


SUMMARY = """count(*) games, count(*) filter (where result > 0) wins, count(*) filter (where result > 0) true_wins, count(*) filter (where result < 0) losses, count(*) filter (where result = 0) ties,
  coalesce(sum(team_score), 0) pf, coalesce(sum(opponent_score), 0) pa, coalesce(sum(team_score), 0) - coalesce(sum(opponent_score), 0) pd, round(count(*) filter (where result > 0) / count(*), 6) win_pct"""
GRID = "played as (select * from long where result is not null), grid as (select season, week, row_number() over (order by season, week) idx from (select distinct season, week from played))"
_GAMES_OF = {
    "season": "sl as (select g.season, g.week, p.team, p.opponent, p.team_score, p.opponent_score, p.result from grid g join played p on p.season = g.season and p.week <= g.week)",
    "roll": "sl as (select g.season, g.week, p.team, p.opponent, p.team_score, p.opponent_score, p.result from grid g join grid h on h.idx between g.idx - {n} and g.idx join played p on p.season = h.season and p.week = h.week)",
}
SRS = """
ids as (select *, dense_rank() over (order by season, week) sid from sl),
lg as (select sid, avg(team_score) m from ids group by 1),
srs as (
  select sid, season, week, team, avg(result) mov, 0::double sos, avg(result) srs, avg(team_score) - any_value(m) osrs, avg(result) - (avg(team_score) - any_value(m)) dsrs, 0 it, 1e9::double delta
  from ids join lg using (sid) group by sid, season, week, team
  union all
  select sid, season, week, team, mov, n_sos, n_srs, n_osrs, n_srs - n_osrs, it + 1,
    max(greatest(abs(n_srs - srs), abs(n_osrs - osrs), abs(n_srs - n_osrs - dsrs))) over (partition by sid)
  from (select s.sid, s.season, s.week, s.team, s.mov, s.srs, s.osrs, s.dsrs, s.it, avg(o.srs) n_sos, avg(i.result + o.srs) n_srs, avg(i.team_score + o.dsrs - lg.m) n_osrs
    from srs s join ids i on i.sid = s.sid and i.team = s.team join srs o on o.sid = s.sid and o.team = i.opponent join lg on lg.sid = s.sid
    where s.delta >= 0.001 and s.it < 100 group by all)),
rated as (select season, week, team, round(mov, 4) "MOV", round(arg_max(sos, it), 4) "SOS", round(arg_max(srs, it), 4) "SRS", round(arg_max(osrs, it), 4) "OSRS", round(arg_max(dsrs, it), 4) "DSRS" from srs group by season, week, team, mov)"""


def _modes(resets: list[int], max_iter: int) -> str:
    """Summary of the season mode and the ratings of every mode, mode 0 being the season, n a window of n weeks."""
    parts = [_GAMES_OF["season" if n == 0 else "roll"].format(n=n - 1).removeprefix("sl as (select ").removesuffix(")") for n in resets]
    rows = " union all ".join(f"select {n} as mode, {x}" for n, x in zip(resets, parts))
    srs = SRS.replace("order by season, week) sid", "order by mode, season, week) sid").replace("select sid, season, week, team, avg(result) mov", "select sid, mode, season, week, team, avg(result) mov")
    srs = srs.replace("group by sid, season, week, team\n", "group by sid, mode, season, week, team\n").replace("select sid, season, week, team, mov, n_sos", "select sid, mode, season, week, team, mov, n_sos")
    srs = srs.replace("select s.sid, s.season", "select s.sid, s.mode, s.season").replace("s.it < 100", f"s.it < {max_iter}")
    srs = srs.replace("rated as (select season", "rated as (select mode, season").replace("group by season, week, team, mov)", "group by mode, season, week, team, mov)")
    wide = ", ".join(f'max(case when mode = {n} then "{r}" end) "{r}{f"_{n}" if n else ""}"' for n in resets for r in ("MOV", "SOS", "SRS", "OSRS", "DSRS"))
    base = SUMMARY.replace(", 6)", ", 4)").replace("count(*) filter (where result > 0) true_wins, ", "")
    return f", {GRID}, sl as ({rows}), {srs} select * from (select season, week, team, {base} from sl where mode = 0 group by all) left join (select season, week, team, {wide} from rated group by all) using (season, week, team)"


def _elo_resume() -> str:
    """Games before 2000 in one fold; then another from each team's rating after its last one, a team without any
    being unknown and starting at the mean of the known ones."""
    chg = "20 * (case when result > 0 then 1.0 when result < 0 then 0.0 else 0.5 end - 1 / (1 + pow(10, (ra - rh) / 400.0)))"
    fold = """select rn, season, [case when i = h then rh + chg when i = a then ra - chg else b[i] end for i in range(1, 26)], rh, ra from (select *, {chg} chg
      from (select *, coalesce(b[h], list_avg(b)) rh, coalesce(b[a], list_avg(b)) ra
        from (select pg.*, case when {el}.season is not null and {el}.season <> pg.season then [x * 0.6 + list_avg({el}.st) * (1 - 0.6) for x in {el}.st] else {el}.st end b from {el} join pg on pg.rn = {el}.rn + 1 where {where})))"""
    games = _elo(0.0, False).split("el as (")[0]
    return f"""{games} el as (select 0::bigint rn, null::int as season, [1500.0::double for i in range(25)] st, null::double hpre, null::double apre union all {fold.format(chg=chg, el="el", where="pg.season < 2000")}),
seed as (select i, arg_max(st[i], rn) x from range(1, 26) t(i) left join (select el.rn, st, h, a from el join pg on pg.rn = el.rn) on h = i or a = i group by i),
more as (select (select max(rn) from el) rn, (select max(season) from el)::int as season, (select list(x order by i) from seed) st, null::double hpre, null::double apre union all {fold.format(chg=chg, el="more", where="true")}),
steps as (select * from el union all select * from more where hpre is not null)
select game_id, pg.season, week, gameday, home_team, away_team, home_score, away_score, location, round(hpre, 6) home_elo_pre, round(apre, 6) away_elo_pre, round(st[h], 6) home_elo_post, round(st[a], 6) away_elo_post from steps join pg using (rn)"""


def _elo(edge: float, margin: bool) -> str:
    e = f"case when location = 'Home' then {edge} else 0.0 end"
    mult = f"case when result = 0 then 1.0 else ln(abs(result) + 1) * 2.2 / (0.001 * abs(b[h] - b[a] + {e}) + 2.2) end" if margin else "1.0"
    return f"""pg as (select row_number() over (order by season, week, gameday, game_id) rn, g.*, h.n_nationkey + 1 h, a.n_nationkey + 1 a from games g join nation h on home_team = h.n_name join nation a on away_team = a.n_name where result is not null),
el as (
  select 0::bigint rn, null::int as season, [1500.0::double for i in range(25)] st, null::double hpre, null::double apre
  union all
  select rn, season, [case when i = h then b[h] + chg when i = a then b[a] - chg else b[i] end for i in range(1, 26)], b[h], b[a]
  from (select *, 20 * ({mult}) * (case when result > 0 then 1.0 when result < 0 then 0.0 else 0.5 end - 1 / (1 + pow(10, (b[a] - (b[h] + {e})) / 400.0))) chg
    from (select pg.*, case when el.season is not null and el.season <> pg.season then [x * 0.6 + list_avg(el.st) * (1 - 0.6) for x in el.st] else el.st end b from el join pg on pg.rn = el.rn + 1))),
hist as (select game_id, pg.season, week, gameday, home_team, away_team, home_score, away_score, location, round(hpre, 6) home_elo_pre, round(apre, 6) away_elo_pre, round(st[h], 6) home_elo_post, round(st[a], 6) away_elo_post from el join pg using (rn))"""


def _prob(o: str, p: str) -> str:
    return f"round(case when {o} < 0 then abs({o}) / (abs({o}) + 100) else 100 / ({o} + 100) end, 6) {p}"


def _series(keys: str) -> str:
    def side(team: str, p: str) -> str:
        by = ", ".join(f"round(case when count(*) filter (where last = {d}) > 0 then count(*) filter (where last = {d} and ok) / count(*) filter (where last = {d}) else 0 end, 6) {p}_scr_{d}" for d in (1, 2, 3, 4))
        return f"select {keys}, team, count(*) {p}_n, round(count(*) filter (where ok) / count(*), 6) {p}_scr, {by} from (select {keys}, {team} team, game_id, drive, bool_or(ok) ok, max(down) last from plays group by all) group by {keys}, team"

    return f"select * from ({side('posteam', 'off')}) left join ({side('defteam', 'def')}) using ({keys}, team)"


_TURN = "tl as (select game_id, season, week, posteam, defteam, count(*) filter (where interception) il, count(*) filter (where fumble_lost) fl, count(*) filter (where interception) + count(*) filter (where fumble_lost) tl from plays group by all)"
_TURN_OUT = "select l.game_id, l.season, l.week, l.team, l.opponent, wt - tl turnover_diff, wt turnover_won, tl turnover_lost, wi interception_won, il interception_lost, wf fumble_won, fl fumble_lost from long l left join tt on tt.game_id = l.game_id and tt.posteam = l.team where l.result is not null"
_RED = """rz as (select game_id, season, week, posteam team, case when posteam = home_team then away_team else home_team end opponent,
    count(*) filter (where inside20) / count(*) app, case when count(*) filter (where inside20) > 0 then count(*) filter (where inside20 and drive_result = 'Touchdown') / count(*) filter (where inside20) else 0 end eff
  from (select distinct game_id, season, week, posteam, home_team, away_team, drive, drive_result, inside20 from plays) group by game_id, season, week, posteam, home_team, away_team)"""
_RED_OUT = """select l.game_id, l.season, l.week, l.team, l.opponent, round(coalesce(o.app, 0), 6) off_red_zone_app_perc, round(coalesce(o.eff, 0), 6) off_red_zone_eff,
  round(coalesce({d}.app, 0), 6) def_red_zone_app_perc, round(coalesce({d}.eff, 0), 6) def_red_zone_eff from long l left join rz o on o.game_id = l.game_id and o.team = l.team {join} where l.result is not null"""
_PATCHED = """pat as (select season, week, team, case when season = 1998 and week = 7 and team = 'NATION_11' then 3 else passing_tds end passing_tds,
  case when season = 1996 and week = 3 and team = 'NATION_4' then 1 else rushing_tds end rushing_tds, case when season = 1998 and week = 7 and team = 'NATION_11' then 0 else special_teams_tds end td_special,
  def_tds, fumble_recovery_tds, passing_2pt_conversions, rushing_2pt_conversions, case when season = 1996 and week = 3 and team = 'NATION_4' then 2 else pat_att end pat_att,
  case when season = 1996 and week = 3 and team = 'NATION_4' then 2 else pat_made end pat_made, fg_att, fg_made, def_safeties safeties_def from stats)"""
_TWO = "select season, week, posteam team, count(*) filter (where two_att) two_pt_att, count(*) filter (where two_made) two_pt_made, count(*) filter (where two_def) two_pt_def from plays group by all"
_STAT_LIST = "passing_tds, rushing_tds, td_special, def_tds, fumble_recovery_tds, passing_2pt_conversions, rushing_2pt_conversions, pat_att, pat_made, fg_att, fg_made, safeties_def".split(", ")


def _poisoned(x: str) -> str:
    return f"case when count(*) filter (where {x} is null) over w > 0 then null else sum({x}) over w end"


_SIDES = ("off", "def")
_FACTS = {
    "e": [f"{s}_{n}_{m}" for s in _SIDES for n in ("total", "pass", "rush", "penalty", "kick", "special") for m in ("plays", "epa_sum", "epa_mean")],
    "s": [*_STAT_LIST, "td_off", "td_def", "td_total", "two_pt_att", "two_pt_made", "two_pt_def", "points8", "points7", "points6", "points3", "points2", "points_total"],
    "r": [f"{s}_{c}" for s in _SIDES for c in ("n", "scr", "scr_1", "scr_2", "scr_3", "scr_4")],
    "t": ["turnover_diff", "turnover_won", "turnover_lost", "interception_won", "interception_lost", "fumble_won", "fumble_lost"],
    "z": [f"{s}_red_zone_{c}" for s in _SIDES for c in ("app_perc", "eff")],
}
_RATES = ["games", "wins", "losses", "ties", "pf", "pa", "pd", "win_pct", "MOV", "SOS", "SRS", "OSRS", "DSRS"]


def _fine(sql: str) -> str:
    """The SQL of a product without its rounding, but for noise."""
    return sql.replace(", 6)", ", 12)").replace(", 4)", ", 12)")


def _held(sql: str, name: str, last: str) -> str:
    """A query, whose last select begins with ``last``, as a table of the name."""
    head, mark, tail = sql.rpartition(last)
    return f"{head.rstrip().removesuffix(',')}, {name} as ({mark}{tail})"


def _model(scores: str, turnovers: str, redzone: str) -> tuple[str, list[str]]:
    """CTEs up to ``ml``, the unrounded features of rated team games, and the names of the features."""
    facts = [c for names in _FACTS.values() for c in names]
    lags = [f"{c}_{kind}_lag" for c in facts for kind in ("cum", "roll", "ewma")]
    nets = [c[4:] for c in lags if c.startswith("off_") and f"def_{c[4:]}" in lags]
    over = "over (partition by team order by season, week, game_id rows between {} preceding and 1 preceding)"
    means = ", ".join(f"avg({c}) {over.format('unbounded')} {c}_cum_lag, avg({c}) {over.format(5)} {c}_roll_lag, list({c}::double) filter (where {c} is not null) {over.format(50)} {c}_p" for c in facts)
    folds = ", ".join(f"case when len({c}_p) > 0 then list_reduce({c}_p, lambda s, x: s * (1 - 2 / 6.0::double) + x * (2 / 6.0::double)) end {c}_ewma_lag" for c in facts)
    before = ", ".join(f'lag("{c}") over (partition by team order by season, week) "srs_{c}_lag"' for c in _RATES)
    ids = "game_id, season, week, team, opponent, week_seq, location, result"
    values = ["team_elo_pre", "opponent_elo_pre", *[f"srs_{c}_lag" for c in _RATES]]
    e = f"select * from ({_epa('off')}) left join ({_epa('def')}) using (game_id, season, week, team, home_team, away_team)"
    parts = "".join([
        f", {_fine(_elo(0.0, False))}, ",
        "es as (select game_id, home_team team, home_elo_pre team_elo_pre, away_elo_pre opponent_elo_pre from hist union all select game_id, away_team, away_elo_pre, home_elo_pre from hist)",
        _held(_fine(_modes([0], 100)), "sd", "select * from (select season, week, team, count(*) games"),
        f", sb as (select season, week, team, {before} from sd), fe as ({_fine(e)}), fr as ({_fine(_series('season, week'))})",
        _held(_fine(scores), "fs", "select *, two_pt_made points8"), _held(_fine(turnovers), "ft", _TURN_OUT[:60]), _held(_fine(redzone), "fz", _RED_OUT[:60]),
        ", fl as (select l.game_id, l.season, l.week, l.team, l.opponent, l.week_seq, l.location, l.result, ", ", ".join(f'"{c}"' for c in values), ", ",
        ", ".join(f"{t}.{c}" for t, names in _FACTS.items() for c in names),
        """ from long l left join es on es.game_id = l.game_id and es.team = l.team left join sb on sb.season = l.season and sb.week = l.week and sb.team = l.team
          left join fe e on e.game_id = l.game_id and e.team = l.team left join fs s on s.game_id = l.game_id and s.team = l.team left join fr r on r.season = l.season and r.week = l.week and r.team = l.team
          left join ft t on t.game_id = l.game_id and t.team = l.team left join fz z on z.game_id = l.game_id and z.team = l.team)""",
        f", fp as (select *, {means} from fl), fg as (select *, {folds} from fp)",
        ", ml as (select ", ", ".join(f'g."{c}"' for c in [*ids.split(", "), *values, *lags]), ", ", ", ".join(f"g.off_{c} - o.def_{c} net_{c}" for c in nets),
        " from fg g left join fg o on o.game_id = g.game_id and o.team = g.opponent where g.team_elo_pre is not null)",
    ])
    return parts, [*values, *lags, *[f"net_{c}" for c in nets]]


def _round4(column: str, name: str) -> str:
    whole = any(f"srs_{c}_lag" in column for c in ("games", "wins", "losses", "ties"))
    return f'{column} "{name}"' if whole else f'round({column} + 1e-9::double, 4) "{name}"'


def queries() -> dict[str, str]:
    lag0 = "coalesce(lag({x}) over (partition by season, team order by week, gameday, game_id), 0)"
    season_sl, roll_sl = _GAMES_OF["season"], _GAMES_OF["roll"].format(n=9)
    form = "over (partition by team order by season, week, game_id rows between {} preceding and 1 preceding)"
    past = f"list(team_score) filter (where team_score is not null) {form.format(50)}"
    pw = f""", pw as (select (1995 + r // 12)::int as season, (r % 12 + 1)::int as week, o_custkey player_id, n_name opponent_team, count(*) attempts, sum(cents)::bigint yards
            from (select {_R} r, o_custkey, c_nationkey k, round(o_totalprice * 100)::bigint cents from orders join customer on o_custkey = c_custkey) join nation on n_nationkey = ((r - k) % 25 + 25) % 25 group by r, k, o_custkey, n_name)"""
    out = {
        "games_clean": """select game_id, season, week, week_seq, game_type, season_type, gameday, gametime, location, case home_team when 'NATION_0' then 'NATION_00' else home_team end home_team,
          case away_team when 'NATION_0' then 'NATION_00' else away_team end away_team, home_score, away_score, result,
          case when result > 0 then case home_team when 'NATION_0' then 'NATION_00' else home_team end when result < 0 then case away_team when 'NATION_0' then 'NATION_00' else away_team end end winner, total, spread_line, total_line from games""",
        "games_odds_prob": "select game_id, " + ", ".join(_prob(o, p) for o, p in (("home_spread_odds", "home_spread_prob"), ("away_spread_odds", "away_spread_prob"), ("under_odds", "under_prob"), ("over_odds", "over_prob"), ("home_moneyline", "home_moneyline_prob"), ("away_moneyline", "away_moneyline_prob"))) + " from games",
        "games_time_of_day": """select game_id, gametime, case when h < 15 then 'Day' when h <= 18 then 'Evening' when h > 18 then 'Night' end time_of_day, case when result > spread_line then true when result < spread_line then false end "spreadCover",
          case when total > total_line then true when total < total_line then false end "totalCover" from (select *, split_part(gametime, ':', 1)::int h from games)""",
        "week_seq": "select distinct season, week, week_seq from games",
        "games_long": 'select game_id, season, week, team, opponent, location, loc::int "locationID", team_score, opponent_score, result, spread_line, winner from long',
        "running_record": f""", rr as (select *, row_number() over w::int as gp, {_poisoned("(result > 0)::int")} w_, {_poisoned("(result < 0)::int")} l_, {_poisoned("team_score")} pf, {_poisoned("opponent_score")} pa
            from long window w as (partition by season, team order by week, gameday, game_id))
          select game_id, season, week, team, gp "team_GP", ({lag0.format(x="w_")})::bigint "team_W", ({lag0.format(x="l_")})::bigint "team_L", ({lag0.format(x="gp - w_ - l_")})::bigint "team_T",
            pf "team_PF", round(pf / gp, 6) "team_PFG", pa "team_PA", round(pa / gp, 6) "team_PAG" from rr""",
        "pair_pivot_wide": """select game_id, case when location = 'Neutral' then least(home_team, away_team) else home_team end home_team, case when location = 'Neutral' then greatest(home_team, away_team) else away_team end away_team,
          case when location = 'Neutral' and away_team < home_team then away_score else home_score end home_team_score, case when location = 'Neutral' and away_team < home_team then home_score else away_score end away_team_score,
          case when location = 'Neutral' and away_team < home_team then -result else result end home_result, case when location = 'Neutral' and away_team < home_team then result else -result end away_result from games""",
        "player_join": f"""{pw}
          select game_id, pw.* from pw left join long l on l.season = pw.season and l.week = pw.week and l.opponent = pw.opponent_team""",
        "ids_cascade_game_team": "select l.game_id, l.season, l.week, l.team, l.opponent, l.location, pat_made from stats s join long l using (season, week, team)",
        "ids_cascade_week_team": "select l.game_id, l.season, l.week, l.team, l.opponent, l.location, passing_tds from stats s join long l using (season, week, team)",
        "ids_cascade_home_away": "select game_id, season, week, home_team, away_team, total from games",
        "ids_cascade_week_opponent": "select l.game_id, l.season, l.week, l.team, l.opponent, l.location, fg_made from stats s join long l on l.season = s.season and l.week = s.week and l.opponent = s.team",
        "missing_keys": "select distinct season, week from games where season >= 2000",
        "period_semi_slice": "select game_id, season, week from games where week_seq between 11 and 30",
        "incremental_upsert": "select game_id, season, result, case when season >= 1999 then total end total from games",
        "epa_offense": _epa("off"),
        "epa_defense": _epa("def"),
        "epa_joined": f"select * from ({_epa('off')}) left join ({_epa('def')}) using (game_id, season, week, team, home_team, away_team)",
        "epa_scaled": _epa("off", "epa * (1 - 4 * (0.5::double - vegas_wp) * (0.5::double - vegas_wp))"),
        "turnovers": f", {_TURN}, tt as (select a.*, b.il wi, b.fl wf, b.tl wt from tl a left join tl b on a.game_id = b.game_id and a.posteam = b.defteam) {_TURN_OUT}",
        "turnovers_global_pairing": f", {_TURN}, nn as (select *, row_number() over (order by season, week, game_id, posteam, defteam) n, count(*) over () c from tl), tt as (select a.*, b.il wi, b.fl wf, b.tl wt from nn a join nn b on b.n = a.c + 1 - a.n) {_TURN_OUT}",
        "redzone": f", {_RED} {_RED_OUT.format(d='d', join='left join rz d on d.game_id = l.game_id and d.opponent = l.team and o.team is not null')}",
        "redzone_first_match": f", {_RED}, ff as (select opponent team, app, eff from rz qualify row_number() over (partition by opponent order by game_id, team) = 1) {_RED_OUT.format(d='d', join='left join ff d on d.team = o.team')}",
        "two_point": _TWO,
        "team_week_stats": "select * from stats",
        "score_patches": f", {_PATCHED} select * from pat",
        "scores": f""", {_PATCHED}, two as ({_TWO}), sc as (select l.game_id, l.season, l.week, l.team, {", ".join(f"coalesce(p.{c}, 0) {c}" for c in _STAT_LIST)}, coalesce(p.passing_tds + p.rushing_tds, 0) td_off,
            coalesce(p.def_tds + p.fumble_recovery_tds, 0) td_def, coalesce(p.passing_tds + p.rushing_tds + p.td_special + p.def_tds + p.fumble_recovery_tds, 0) td_total,
            coalesce(t.two_pt_att, 0) two_pt_att, coalesce(t.two_pt_made, 0) two_pt_made, coalesce(o.two_pt_def, 0) two_pt_def
          from long l left join pat p using (season, week, team) left join two t using (season, week, team) left join two o on o.season = l.season and o.week = l.week and o.team = l.opponent where l.result is not null)
          select *, two_pt_made points8, pat_made points7, td_total - two_pt_made - pat_made points6, fg_made points3, safeties_def + two_pt_def points2,
            two_pt_made * 8 + pat_made * 7 + (td_total - two_pt_made - pat_made) * 6 + fg_made * 3 + (safeties_def + two_pt_def) * 2 points_total from sc""",
        "series_weekly": _series("season, week"),
        "series_season": _series("season"),
        "series_ids": f"select l.game_id, l.season, l.week, l.team, l.opponent, l.location, s.* exclude (season, week, team) from ({_series('season, week')}) s join long l using (season, week, team)",
        "stats_week_team_all": f"select l.game_id, l.season, l.week, l.team, l.opponent, l.location, l.season_type, 1::bigint games, {', '.join(f'{c}::bigint {c}' for c in STATS)} from stats s join long l using (season, week, team)",
        "stats_season_team_reg": f"select season, team, season_type, count(distinct week) games, {', '.join(f'sum({c})::bigint {c}' for c in STATS)} from stats join (select distinct season, week, season_type from games) using (season, week) where season_type = 'REG' group by all",
        "stats_week_player_post": f"{pw} select season, week, player_id, season_type, 1::bigint games, sum(attempts)::bigint attempts, sum(yards)::bigint yards from pw join (select distinct season, week, season_type from games) using (season, week) where season_type = 'POST' group by all",
        "stats_season_player_both": f"{pw} select season, player_id, 'REG+POST' season_type, count(distinct week) games, sum(attempts)::bigint attempts, sum(yards)::bigint yards from pw where season between 1995 and 2001 group by all",
        "weekly_standings_season": f", {GRID}, {season_sl} select season, week, team, {SUMMARY} from sl group by all",
        "weekly_standings_roll10": f", {GRID}, {roll_sl} select season, week, team, {SUMMARY} from sl group by all",
        "weekly_standings_reg": f", {GRID.replace('result is not null', chr(39).join(['result is not null and season_type = ', 'REG', '']), 1)}, {season_sl} select season, week, team, {SUMMARY} from sl group by all",
        "srs_season": f", {GRID}, {season_sl}, {SRS} select * from (select season, week, team, {SUMMARY.replace(', 6)', ', 4)')} from sl group by all) left join rated using (season, week, team)",
        "srs_slice_weekly": f", {GRID}, {roll_sl}, {SRS} select * from rated",
        "srs_multi_mode": _modes([0, 10, 20], 100),
        "srs_17_modes": _modes([0, *range(5, 21)], 200),
        "season_standings_ratings": f""", sl as (select season, 1 as week, team, opponent, team_score, opponent_score, result from long where result is not null and season_type = 'REG'), ss as (select season, team, {SUMMARY.replace(", 6)", ", 4)")} from sl group by all), {SRS}
          select * exclude (true_wins) from ss left join (select * exclude (week) from rated) using (season, team) left join (select r.season, r.team, round(sum(s.wins) filter (where r.result > 0) / sum(s.games) filter (where r.result > 0), 4) sov, round(sum(s.wins) / sum(s.games), 4) schedule_share
            from sl r join ss s on s.season = r.season and s.team = r.opponent group by 1, 2) using (season, team)""",
        "season_standings": f""", rg as (select * from long where result is not null and season_type = 'REG'), ss as (select season, team, {SUMMARY} from rg group by all)
          select * exclude (true_wins) from ss left join (select r.season, r.team, round(sum(s.wins) filter (where r.result > 0) / sum(s.games) filter (where r.result > 0), 6) sov, round(sum(s.wins) / sum(s.games), 6) schedule_share
            from rg r join ss s on s.season = r.season and s.team = r.opponent group by 1, 2) using (season, team)""",
        "elo_full": f", {_elo(0.0, False)} select * from hist",
        "elo_resume": f", {_elo_resume()}",
        "elo_hfa_margin": f", {_elo(65.0, True)} select * from hist",
        "elo_latest": f", {_elo(0.0, False)}, ts as (select home_team team, season, week, game_id, home_elo_post e from hist union all select away_team, season, week, game_id, away_elo_post from hist) select team, arg_max(e, (season, week, game_id)) elo, max(season) season from ts group by team",
        "team_form_lag": f"select game_id, season, week, team, team_score, round(avg(team_score) {form.format('unbounded')}, 6) team_score_cum_lag, round(avg(team_score) {form.format(5)}, 6) team_score_roll_lag from long",
        "team_ewma_lag": f"select game_id, team, round(case when len(p) > 0 then list_reduce(p, lambda s, x: s * (1 - 2 / 6.0::double) + x * (2 / 6.0::double)) end, 6) team_score_ewma_lag from (select *, {past} p from long)",
    }
    model, names = _model(out["scores"], out["turnovers"], out["redzone"])
    out["model_long"] = f"{model} select game_id, season, week, team, opponent, week_seq, location, round(result + 1e-9::double, 4) result, {', '.join(_round4(f'ml.{chr(34)}{c}{chr(34)}', c) for c in names)} from ml"
    sided = ", ".join(_round4(f'{side}."{c}"', f"{side}_{c}") for side in ("home", "away") for c in names)
    out["model_wide"] = f"{model} select g.game_id, g.season, g.week, g.week_seq, g.home_team, g.away_team, round(g.result + 1e-9::double, 4) result, {sided} from games g left join ml home on home.game_id = g.game_id and home.team = g.home_team left join ml away on away.game_id = g.game_id and away.team = g.away_team"
    # products kept current hold what a full build holds
    out |= {"elo_stream": out["elo_full"], "srs_slices": out["srs_multi_mode"], "series_kept": out["series_weekly"], "stats_kept": out["stats_season_team_reg"]}
    out["epa_bucketed"] = f"select * from ({out['epa_joined']}) where season in (1996, 1999)"
    of_kind = "select player_id from pw join customer on c_custkey = player_id where c_mktsegment = 'FURNITURE'"
    out["player_kicking"] = out["player_join"] + f" where pw.season in (1996, 1997, 1999) and player_id in ({of_kind})"
    return {name: f"{BASE} {sql}" for name, sql in out.items()}
