"""Repeatable draws and geography as expressions; the uniform is a column, so re-runs agree."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.functions.formulas import lookup
from cargolume.functions.keys import uniform


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    a1, a2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    half = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin(F.radians(_c(lon2) - _c(lon1)) / 2), 2)
    return 2 * P.EARTH_RADIUS_KM * F.asin(F.sqrt(half))


def road_distance_km(lat1, lon1, lat2, lon2) -> Column:
    return F.bround(haversine_km(lat1, lon1, lat2, lon2) * P.ROAD_DETOUR, 1)


def city_pair_distances(pairs: DataFrame, cities: DataFrame) -> DataFrame:
    """Road distance of every ordered pair of different cities that occurs; two lookups of a city table."""
    a = cities.select(F.col("city").alias("Origin"), F.col("lat").alias("_la"), F.col("lon").alias("_lo"))
    b = cities.select(F.col("city").alias("Destination"), F.col("lat").alias("_lb"), F.col("lon").alias("_lp"))
    return (pairs.select("Origin", "Destination").distinct().where("Origin <> Destination")
            .join(a, "Origin").join(b, "Destination")
            .select("Origin", "Destination", road_distance_km("_la", "_lo", "_lb", "_lp").alias("road_km")))


def normal(seed, *columns) -> Column:
    """A repeatable standard normal per key (Box-Muller)."""
    u = F.greatest(uniform(seed, *columns), F.lit(1e-12))
    return F.sqrt(-2.0 * F.ln(u)) * F.cos(2.0 * F.pi() * uniform(seed + 1, *columns))


def vehicle_probabilities(seed=42, vendor="Vendor_ID", distance="Distance_km", weight="Weight_tons") -> Column:
    """Array of dispatch probabilities in fleet order: softmax of distance, load and the vendor's own bias."""
    d = (_c(distance) - P.DISTANCE_CENTRE) / P.DISPATCH_DISTANCE_SCALE
    w = (_c(weight) - P.DISPATCH_WEIGHT_CENTRE) / P.DISPATCH_WEIGHT_SCALE
    utility = [F.lit(P.DISPATCH_BASE[v]) + d * P.DISPATCH_DISTANCE[v] + w * P.DISPATCH_WEIGHT[v]
               + normal(seed, F.col(vendor), F.lit(v)) * P.FLEET_BIAS_SD for v in P.VEHICLES]
    # Every step is bound to a name, since an expression inside a lambda is evaluated again for each element.
    return _bound(F.array(*utility), lambda u: _bound(F.array_max(u), lambda top: _bound(
        F.transform(u, lambda x: F.exp(x - top)), lambda weights: _bound(
            F.aggregate(weights, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(weights, lambda x: x / total)))))


def _bound(value: Column, then) -> Column:
    """`then` of a value that is evaluated once a row."""
    return F.transform(F.array(value), then)[0]


def pick_category(probabilities: Column, u: Column, names) -> Column:
    """Inverse CDF: the first category whose cumulated probability reaches u."""
    steps = F.aggregate(
        probabilities, F.struct(F.lit(0.0).alias("upto"), F.lit(0).alias("passed")),
        lambda a, x: F.struct((a["upto"] + x).alias("upto"),
                              (a["passed"] + F.when(a["upto"] + x < u, 1).otherwise(0)).alias("passed")))
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.least(steps["passed"], F.lit(len(names) - 1)) + 1)


def assign_vehicle(seed=42, key="Shipment_ID", **kw) -> Column:
    return pick_category(vehicle_probabilities(seed, **kw), uniform(seed + 7, F.col(key)), P.VEHICLES)


def severity(rating="Vendor_Rating", weather="Weather_Condition", traffic="Traffic_Density") -> Column:
    mean = F.lit(P.SEVERITY_BASE) + lookup(weather, P.WEATHER_SEVERITY) + lookup(traffic, P.TRAFFIC_SEVERITY) \
        + (F.lit(P.VENDOR_CENTRE) - _c(rating)) * P.SEVERITY_VENDOR
    return F.greatest(mean, F.lit(P.SEVERITY_FLOOR))


def truncated_poisson_days(mean: Column, u: Column, longest=P.MAX_DELAY_DAYS) -> Column:
    """1..longest by inverse CDF of a Poisson law cut to 0..longest-1 and normalised."""
    weights, fact = [], 1.0
    for k in range(longest):
        fact *= max(k, 1)
        weights.append(F.pow(mean, F.lit(float(k))) / fact)
    total = sum(weights[1:], weights[0])
    upto, days = F.lit(0.0), F.lit(1)
    for w in weights:
        upto = upto + w / total
        days = days + (u > upto).cast("int")
    return F.least(days, F.lit(longest)).cast("int")
