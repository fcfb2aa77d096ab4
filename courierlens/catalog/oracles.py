"""The registered queries once more, as plain SQL over the driver tables.

Written independently of the library: whole-key windows instead of sliced
ones, ranks instead of aggregates. Times are microseconds, and measured
doubles are rounded to integers of a ten-thousandth.
"""

from __future__ import annotations

EPOCH = 1_704_067_200_000_000
HOUR = 3_600_000_000
ISTANBUL = 3 * HOUR  # in January; London is at zero

POINTS = f"""
e as (select event_id, user_id, event_type, value, epoch_us(ts) as us from events),
ea as (select *, case when event_type = 'purchase' and event_id % 3 = 0 then event_id end as anchor from e),
es as (select *, last_value(anchor ignore nulls) over (partition by user_id order by us, event_id
       rows between unbounded preceding and current row) as seg from ea),
ep as (select *, row_number() over (partition by seg order by us, event_id) as pos from es where seg is not null),
pts as (select event_id, event_type, cast(user_id as varchar) as courier, cast(5.0 as double) as acc,
        case when pos <= 6 then 700 else 900 end as status, {EPOCH} + (us - {EPOCH}) // 600 as t,
        cast(41.0 as double) + (value - 100 * floor(value / 100)) * cast(0.00012 as double) as lat,
        cast(29.0 as double) + (event_id % 7) * cast(0.00001 as double) as lon,
        case when pos <= 12 then 'o' || cast(seg as varchar) end as raw_id, seg from ep),
trc as (select *, last_value(raw_id ignore nulls) over (partition by courier order by t, lat, lon
        rows between unbounded preceding and current row) as route_id from pts),
"""
ANCHORS = f"""
ek as (select event_id as eid, user_id, {EPOCH} + (epoch_us(ts) - {EPOCH}) // 600 as t,
       row_number() over (partition by user_id order by epoch_us(ts), event_id) as n
       from events where event_type = 'purchase' and event_id % 3 = 0),
og as (select *, 'o' || cast(eid as varchar) as id, cast(user_id as varchar) as courier,
       cast(user_id % 25 as varchar) as country,
       case when eid % 11 <> 0 then 'j' || cast(user_id as varchar) || '-' ||
            cast(cast(floor((n - 1) / 2.0) as bigint) as varchar) end as job,
       cast((n - 1) % 2 + 1 as int) as batch,
       t - 120000000 as checkout_us, t - 60000000 as handover_us, t + 30000000 as onway_us,
       t + 120000000 as reach_us, t + 300000000 as deliver_us,
       cast(29.0 as double) as cl_lon, cast(41.0040 as double) as cl_lat,
       cast(29.0 as double) as wh_lon, cast(41.0 as double) as wh_lat,
       cast(29.0 as double) as me_lon, cast(41.0 as double) as me_lat from ek),
ob as (select *, coalesce(job, 'r' || cast(eid as varchar)) as route from og),
"""
ORDERS = (
    ANCHORS
    + """
ords as (select *, case user_id % 3 when 0 then 'Europe/Istanbul' when 1 then 'Europe/London' end as tz from ob),
"""
)
RAW_ORDERS = (
    ANCHORS
    + """
raws as (select *, case when eid % 13 = 0 then 800 when eid % 5 = 0 then 1000 else 900 end as status,
         case when eid % 7 = 0 then 3 when eid % 5 = 1 then 4 else 1 end as domaintype from ob),
zones as (select cast(n_nationkey as varchar) as country,
          case when n_nationkey % 2 = 0 then 'Europe/Istanbul' else 'Europe/London' end as tz
          from nation where n_nationkey % 5 <> 4),
"""
)
PREDICTIONS = """
made as (select o_orderkey as prediction_id, 'o' || cast(o_custkey as varchar) as order_id,
         case when o_orderstatus <> 'P' then epoch_us(o_orderdate) end as date_us,
         cast(41.0 as double) + o_orderkey % 100 * cast(0.0001 as double) as latitude,
         cast(29.0 as double) + o_orderkey % 50 * cast(0.0001 as double) as longitude,
         epoch_us(o_orderdate) as at_us from orders),
"""
JOB_PREDICTIONS = """
jp as (select eid as prediction_id, 'o' || cast(eid as varchar) as order_id,
       case when eid % 4 <> 0 then t + 30000000 + eid % 5 * 10000000 end as date_us,
       cast(41.0 as double) + eid % 10 * cast(0.0001 as double) as latitude,
       cast(29.0 as double) + eid % 20 * cast(0.0001 as double) as longitude from ek),
"""
MERCHANT = """
usr as (select distinct user_id from events),
cdom as (select cast(user_id as varchar) as courier, cast(1 + user_id % 3 as int) as line from usr
         union all select cast(user_id as varchar), 2 from usr where user_id % 2 = 0),
whs as (select cast(s_suppkey as varchar) as warehouse,
        cast(41.0 as double) + (s_suppkey % 10) * cast(0.0001 as double) as lat, cast(29.0 as double) as lon
        from supplier where s_suppkey % 9 <> 8),
slog as (select raw_id as order_id, case event_type when 'click' then 'm' when 'view' then 'c' end as method,
         lat, lon, t from pts where event_type in ('click', 'view')),
piv as (select order_id, max(case when method = 'm' then lat end) as m_lat, max(case when method = 'm' then lon end) as m_lon,
        max(case when method = 'm' then t end) as m_us, max(case when method = 'c' then lat end) as c_lat,
        max(case when method = 'c' then lon end) as c_lon, max(case when method = 'c' then t end) as c_us
        from slog where order_id is not null group by order_id),
"""
FOOD_ORDERS = """
fords as (select r.eid, r.route, r.id, r.courier, r.checkout_us, r.deliver_us, r.reach_us, r.handover_us,
          r.cl_lon, r.cl_lat, r.me_lon, r.me_lat, piv.m_lat, piv.m_lon, piv.m_us, piv.c_lat, piv.c_lon, piv.c_us,
          'Europe/Istanbul' as tz, whs.lat as wh_lat, whs.lon as wh_lon, cast(null as bigint) as onway_us,
          cast(null as varchar) as job, cast(null as int) as batch
          from raws r left join made on made.order_id = r.id left join piv on piv.order_id = r.id
          left join whs on whs.warehouse = cast(r.user_id % 40 as varchar)
          where r.status in (900, 1000) and 1 + r.eid % 2 = 1 and (made.order_id is null or made.date_us is null)
          and r.deliver_us between {start} and {end}),
"""
MARKET_ORDERS = """
mfin as (select * from raws where status in (900, 1000) and domaintype in (1, 3)
         and deliver_us between {start} - 3600000000 and {end} + 3600000000),
mjob as (select mfin.* exclude (onway_us, handover_us), zones.tz, max(onway_us) over (partition by job) as onway_us,
         first_value(handover_us) over (partition by job order by batch desc nulls first, id desc
             rows unbounded preceding) as handover_us,
         max(deliver_us) over (partition by job) as max_deliver_us
         from mfin left join zones on mfin.country = zones.country),
mords as (select * from mjob where max_deliver_us between {start} and {end}),
"""
WATER_ORDERS = """
words as (select r.*, zones.tz from raws r left join made on made.order_id = r.id
          left join zones on r.country = zones.country
          where r.status in (900, 1000) and (made.order_id is null or made.date_us is null)
          and r.deliver_us between {start} and {end} and r.domaintype = 4),
"""

WHOLE = {"start": EPOCH, "end": EPOCH + 2 * HOUR}
PART = {"start": EPOCH + HOUR // 6, "end": EPOCH + HOUR * 65 // 60}
BINS = (50, 100, 150, 250, 400, 650, 1050)


def e4(expr: str) -> str:
    return f"cast(floor(({expr}) * 10000 + 0.5) as bigint)"


def metres(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    chord = (
        f"sin((radians({lat2}) - radians({lat1})) / 2) * sin((radians({lat2}) - radians({lat1})) / 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * "
        f"sin((radians({lon2}) - radians({lon1})) / 2) * sin((radians({lon2}) - radians({lon1})) / 2)"
    )
    return f"(12742.0::double * asin(sqrt(least(1.0::double, {chord}))) * 1000)"


def bin_of(distance: str) -> str:
    return "case " + " ".join(f"when {distance} < {edge} then {i}" for i, edge in enumerate(BINS)) + " else 7 end"


def local(us: str, tz: str = "tz") -> str:
    return f"case when {tz} = 'Europe/Istanbul' then {us} + {ISTANBUL} else {us} end"


def reach_features(x: str, orders: str, place: str) -> str:
    """CTEs ``{x}f``: features of the reach rule."""
    return f"""
{x}d as (select tr.t, tr.lat, tr.lon, o.*, tr.acc, tr.raw_id,
         round_even({metres('tr.lon', 'tr.lat', f'o.{place}_lon', f'o.{place}_lat')}, 0) as distance,
         count(tr.t) over (partition by o.id) as points
         from trc tr join {orders} o on tr.route_id = o.id),
{x}b as (select *, {bin_of('distance')} as bin from {x}d where points >= 3),
{x}n as (select *, lead(t) over w as next_t, lag(bin) over w as prev_bin,
         coalesce(cast(floor((lead(t) over w - t) / 1000000.0) as bigint) % 86400, 0) as tbe,
         case when bin is distinct from lag(bin) over w then 1 else 0 end as changed,
         min(t) over (partition by id) as first_t, max(t) over (partition by id) as last_t
         from {x}b window w as (partition by id order by t, lat, lon)),
{x}g as (select *, sum(changed) over (partition by id order by t, lat, lon rows unbounded preceding) as run from {x}n),
{x}f as (select *, sum(tbe) over (partition by id, run order by t, lat, lon rows unbounded preceding) as in_bin from {x}g),
"""


def reach(x: str, orders: str, place: str) -> str:
    """CTEs ``{x}r``: first points where the rule holds, by rank."""
    return (
        reach_features(x, orders, place)
        + f"""
{x}h as (select *, rank() over (partition by id order by t) as rk from {x}f
         where -0.414 + bin * -0.815 + ln(in_bin + 1) * 0.407 >= 0),
{x}r as (select id, t, {local('t')} as t_l, lat, lon from {x}h where rk = 1),
"""
    )


def movement(x: str, source: str, place: str, order: str = "t, lat, lon") -> str:
    """CTEs ``{x}m``: movement features over the rows of ``source`` (id, t, lat, lon, ...)."""
    return f"""
{x}c as (select *, {metres('lon', 'lat', f'{place}_lon', f'{place}_lat')} as dist,
         count(t) over (partition by id) as points from {source}),
{x}s as (select *, (t - lag(t) over w) / 1000000.0::double as sec, dist - lag(dist) over w as change,
         lag(lat) over w as prev_lat, lag(lon) over w as prev_lon
         from {x}c where points >= 3 window w as (partition by id order by {order})),
{x}v as (select *, {metres('lon', 'lat', 'prev_lon', 'prev_lat')} as moved,
         case when sec <> 0 then change / sec end as v_to,
         case when sec <> 0 then {metres('lon', 'lat', 'prev_lon', 'prev_lat')} / sec end as v_along from {x}s),
{x}m as (select *, case when count(v_to) over w = 3 then avg(v_to) over w end as s_to,
         case when count(v_along) over w = 3 then avg(v_along) over w end as s_along,
         case when dist > 0 then ln(dist) end as log_dist
         from {x}v window w as (partition by id order by {order} rows between 1 preceding and 1 following)),
"""


LEAVES = "coalesce(-5.234 + s_to * 0.557 + s_along * 0.047 + log_dist * 1.165 >= 0, false)"


def depart_features(x: str, orders: str, place: str, complete: str) -> str:
    """CTEs ``{x}p``: movement rows without any missing value."""
    return (
        f"""
{x}j as (select tr.t, tr.lat, tr.lon, tr.acc, tr.raw_id, tr.status as point_status, o.*
         from trc tr join {orders} o on tr.route_id = o.id),
"""
        + movement(x, f"{x}j", place)
        + f"""
{x}p as (select * from {x}m where raw_id is not null and s_to is not null and s_along is not null
         and log_dist is not null and sec is not null and {complete}),
"""
    )


def depart(x: str, orders: str, place: str, complete: str, onway: bool) -> str:
    """CTEs ``{x}q``: the row ranked just before a leaving row, earliest per order."""
    after = "t > onway_us" if onway else "true"
    return (
        depart_features(x, orders, place, complete)
        + f"""
{x}k as (select *, row_number() over w as rn, lag(dist) over w as prev_dist from {x}p
         window w as (partition by id order by t, lat, lon)),
{x}y as (select id, case when rn > 1 then rn - 1 else rn end as last_false from {x}k
         where {LEAVES} and prev_dist < 150 and {after}),
{x}z as (select k.*, row_number() over (partition by k.id order by k.t, k.lat, k.lon) as pick
         from {x}k k join {x}y y on k.id = y.id and k.rn = y.last_false where {after}),
{x}q as (select id, t, {local('t')} as t_l, lat, lon from {x}z where pick = 1),
"""
    )


def first_batch(x: str, orders: str, found: str) -> str:
    """CTEs ``{x}u``: predictions of each job's first batch, given to the whole job."""
    return f"""
{x}o1 as (select id, job, row_number() over (partition by job order by id) as rn from {orders}
          where job is not null and batch = 1),
{x}b1 as (select o1.job, o1.id as first_id, q.t, q.t_l, q.lat, q.lon from {x}o1 o1 left join {found} q on q.id = o1.id
          where o1.rn = 1),
{x}u as (select o.id, b.t, b.t_l, b.lat, b.lon from {orders} o join {x}b1 b on o.job = b.job
         where o.id = b.first_id or (o.batch > 1 and b.t is not null)),
"""


def tail(x: str, orders: str) -> str:
    """CTEs ``{x}a``: traces with the points of the next route of the job appended."""
    return f"""
{x}j as (select tr.t, tr.lat, tr.lon, tr.acc, tr.raw_id, tr.status as point_status, o.*
         from trc tr join {orders} o on tr.route_id = o.id),
{x}e as (select job, id, max(t) as last_t from {x}j where job is not null group by job, id),
{x}x as (select id, lead(id) over (partition by job order by last_t, id) as next_id from {x}e),
{x}t as (select tr.t, tr.lat, tr.lon, tr.acc, tr.raw_id, tr.status as point_status, o.*
         from {x}x nx join trc tr on tr.route_id = nx.next_id join {orders} o on o.id = nx.id),
{x}a as (select * from {x}j union all select * from {x}t),
"""


def client_departure(x: str, orders: str, with_tail: bool) -> str:
    """CTEs ``{x}l``: departures from the client, by ranks with ties."""
    source = (
        tail(x, orders)
        if with_tail
        else f"""
{x}a as (select tr.t, tr.lat, tr.lon, tr.acc, tr.raw_id, tr.status as point_status, o.*
         from trc tr join {orders} o on tr.route_id = o.id),
"""
    )
    return (
        source
        + movement(x, f"{x}a", "cl")
        + f"""
{x}k as (select *, rank() over (partition by id order by t) as rn,
         lag(dist) over (partition by id order by t, lat, lon) as prev_dist from {x}m),
{x}h as (select id, rn, rank() over (partition by id order by t) as true_rn from {x}k
         where {LEAVES} and t >= reach_us and prev_dist < 150 and (t - reach_us > 90000000 or t >= deliver_us)),
{x}y as (select distinct id, case when rn > 1 then rn - 1 else rn end as last_false from {x}h where true_rn = 1),
{x}z as (select k.*, row_number() over (partition by k.id order by k.rn, k.lat, k.lon) as pick
         from {x}k k join {x}y y on k.id = y.id
         where k.t >= k.reach_us and (k.rn = y.last_false or k.rn = y.last_false + 1)),
{x}l as (select id, t, {local('t')} as t_l, lat, lon from {x}z where pick = 1),
"""
    )


def delivery(x: str, reached: str, left: str) -> str:
    """CTEs ``{x}v``: halfway between reaching and leaving."""
    return f"""
{x}one as (select *, row_number() over (partition by id order by t, lat, lon) as one from {reached}),
{x}v as (select l.id, r.t + cast(trunc((l.t - r.t) / 2.0) as bigint) as t,
         r.t_l + cast(trunc((l.t_l - r.t_l) / 2.0) as bigint) as t_l, l.lat, l.lon
         from {x}one r join {left} l on r.id = l.id where r.one = 1),
"""


def build(ctes: str, select: str) -> str:
    return "with " + ctes.strip().rstrip(",") + "\n" + select


OUT = "t as time_us, t_l as local_us, lat, lon"


def completed(orders: str, found: str) -> str:
    return f"select o.id as order_id, f.t as time_us, f.t_l as local_us, f.lat, f.lon from {orders} o left join {found} f on f.id = o.id"


COMPLETE = "tz is not null and job is not null"
COMPLETE_FOOD = "m_lat is not null and c_lat is not null and wh_lat is not null"
BASE = POINTS + ORDERS


def rfm_ranks(check: str) -> str:
    return f"""
fin as (select l_orderkey as order_id, cast(sum(cast(floor(l_extendedprice * (1 - l_discount) * 100) as bigint)) as double) as net,
        cast(sum(cast(floor(l_extendedprice * l_tax * 100) as bigint)) as double) as margin,
        cast(sum(cast(floor(l_quantity * 100) as bigint)) as double) as anm from lineitem group by l_orderkey),
rc as (select *, case when o_custkey % 50 <> 7 then 'c' || cast(o_custkey as varchar) end as client from orders),
ro as (select o_orderkey as id, client, o_orderdate as checkout_date, net, margin, anm,
       'type' || cast(o_orderkey % 2 as varchar) as device_type, 'maker' || cast(o_orderkey % 3 as varchar) as maker,
       'model' || cast(o_orderkey % 5 as varchar) as model, o_orderpriority as store,
       300 + o_orderkey % 900 as h,
       row_number() over (partition by client order by o_orderdate desc, o_orderkey desc) as y,
       row_number() over (partition by client order by o_orderdate, o_orderkey) as t
       from rc join fin on o_orderkey = order_id
       where o_orderstatus in ('F', 'O') and cast(o_orderdate as date) <= date '{check}'),
"""


def rfm_values(check: str, churn: int, f_days: int, first_n: int, last_n: int, store_n: int) -> str:
    age = f"date_diff('day', cast(checkout_date as date), date '{check}')"
    return (
        rfm_ranks(check)
        + f"""
rz as (select *, sum(case when y <= {last_n} then net else 0 end) over (partition by client, device_type, maker, model) as z,
       sum(case when y <= {store_n} then net else 0 end) over (partition by client, store) as st from ro),
rm as (select *, row_number() over (partition by client order by z desc, id) as m,
       row_number() over (partition by client order by st desc, id) as m2 from rz),
rv as (select client, count(id) as t_value, date_diff('day', cast(max(checkout_date) as date), date '{check}') as r_value,
       sum(case when {age} <= {churn} then net else 0 end) as money,
       sum(case when {age} <= {churn} then margin else 0 end) as margins,
       sum(case when {age} <= {churn} then 1 else 0 end) as freq,
       sum(case when {age} <= {f_days} then 1 else 0 end) as f_raw,
       max(case when m = 1 then device_type end) as device_type, max(case when m = 1 then maker end) as device_brand,
       max(case when m = 1 then model end) as device_model, max(case when m2 = 1 then store end) as best_store,
       sum(case when t <= {first_n} then anm else 0 end) as anm5_value,
       avg(case when {age} <= {churn} then h end) as h_value from rm group by client),
rg as (select client, r_value, t_value, case when r_value <= {churn} then money / freq else 0 end as m_value,
       case when r_value <= {churn} then margins / freq else 0 end as g_value,
       cast(case when r_value <= {churn} then f_raw else 0 end as bigint) as f_value, anm5_value, h_value,
       device_type, device_brand, device_model, best_store,
       case when r_value <= {churn} then 1 else 0 end as is_recent from rv),
"""
    )


def rfm_segments() -> str:
    def tile(name: str, value: str, order: str) -> str:
        return f"ntile(4) over (partition by is_recent order by {value} {order}, client nulls first) as {name}"

    tiles = ", ".join(
        [
            tile("r_class", "r_value", "asc nulls last"),
            tile("f_class", "f_value", "desc nulls first"),
            tile("t_class", "t_value", "desc nulls first"),
            tile("m_class", "m_value", "desc nulls first"),
            tile("g_class", "g_value", "desc nulls first"),
            tile("anm5_class", "anm5_value", "asc nulls last"),
            tile("h_class", "h_value", "asc nulls last"),
        ]
    )
    return f"rs as (select *, {tiles} from rg),\n"
