"""SQL fragments: the derived customers, policies, requests and features as common table expressions."""

from __future__ import annotations

from riskloom import fixed_values as fv
from riskloom.sources.views import YEAR

AS_OF = "2024-01-31 00:00:00"


def text_list(values: list) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def number_list(values: list) -> str:
    return "[" + ", ".join(f"{v}" for v in values) + "]"


def case_of(key: str, mapping: dict, otherwise: str = "NULL") -> str:
    def literal(v) -> str:
        return f"'{v}'" if isinstance(v, str) else f"{v}"

    whens = " ".join(f"WHEN {literal(k)} THEN {v}e0" for k, v in mapping.items())
    return f"(CASE {key} {whens} ELSE {otherwise} END)"


def padded(prefix: str, n: str, width: int) -> str:
    return f"'{prefix}' || lpad(({n})::VARCHAR, greatest({width}, length(({n})::VARCHAR))::INTEGER, '0')"


def rounded(x: str, digits: int) -> str:
    scale = 8 if digits <= 6 else 12
    return f"round(({x})::DECIMAL(28,{scale}), {digits})::DOUBLE"


def with_(body: str, **ctes: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in ctes.items()) + "\n" + body


def people(table: str, key: str, region: str) -> str:
    return f"""
SELECT {padded('CUST_', 'k', 6)} AS customer_id,
  ({text_list(fv.FIRST_NAMES)})[k % 16 + 1] AS first_name,
  ({text_list(fv.LAST_NAMES)})[(k // 16) % 16 + 1] AS last_name,
  18 + (k * 7) % 63 AS age,
  CASE WHEN k % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  greatest(1, least(18 + (k * 7) % 63 - 16, (k * 13) % 45)) AS years_licensed,
  (k * 5) % 7 AS claims_history,
  300 + (k * 37) % 551 AS credit_score,
  ({text_list(fv.STATES)})[r % 10 + 1] AS state
FROM (SELECT {key}::BIGINT AS k, {region}::BIGINT AS r FROM {table})"""


CUSTOMERS = people("customer", "c_custkey", "c_nationkey")
PROSPECTS = people("part", "p_partkey", "p_size")


def vehicle_columns(o: str) -> str:
    makes = list(fv.CAR_MAKES)
    return f"""
  ({text_list(makes)})[{o} % 8 + 1] AS car_make,
  ({text_list(makes)})[{o} % 8 + 1] || '-' || (({o} // 8) % 5)::VARCHAR AS car_model,
  2010 + {o} % 16 AS car_year,
  1000 + ({o} * 97) % 240000 AS kilometers,
  (({number_list(fv.ENGINE_SIZES)})[({o} // 2) % 9 + 1])::DOUBLE AS engine_size,
  CASE WHEN {o} % 8 = 6 THEN 'Electric' ELSE ({text_list(fv.FUEL_TYPES)})[({o} // 3) % 4 + 1] END AS fuel_type,
  ({text_list(fv.TRANSMISSIONS)})[({o} // 5) % 3 + 1] AS transmission,
  ({text_list(fv.COVERAGE_TYPES)})[({o} // 7) % 4 + 1] AS coverage_type"""


def value_of(make: str, age: str, km: str, otherwise: str = "30000e0") -> str:
    return f"({case_of(make, fv.BASE_PRICES, otherwise)} * pow(0.85e0, ({age})::DOUBLE) * greatest(0.5e0, 1 - {km} / 300000))"


VEHICLES = f"""
SELECT *, {rounded(value_of('car_make', f'{YEAR} - car_year', 'kilometers'), 2)} AS estimated_car_value
FROM (SELECT {padded('POL_', 'o_orderkey', 7)} AS policy_id, {padded('CUST_', 'o_custkey', 6)} AS customer_id,
  {vehicle_columns('o_orderkey')},
  (({number_list(fv.DEDUCTIBLES)})[(o_orderkey // 11) % 5 + 1])::BIGINT AS deductible,
  o_orderdate AS updated_at
FROM orders)"""


def premium(value: str = "estimated_car_value", noise: str = "") -> str:
    return f"""greatest(400e0, least(5000e0, 800
  * (CASE WHEN age < 25 THEN 1.5e0 WHEN age > 65 THEN 1.2e0 ELSE 1.0e0 END)
  * greatest(0.8e0, 1.3e0 - years_licensed * 0.02e0)
  * (1 + claims_history * 0.15e0)
  * greatest(0.8e0, 1.3e0 - (credit_score - 600) / 500)
  * (1 + 0.03e0 * ({value} / 10000))
  * {case_of('car_make', fv.MAKE_FACTORS, '1.0e0')}
  * {case_of('coverage_type', fv.COVERAGE_FACTORS)}
  * {case_of('deductible', fv.DEDUCTIBLE_FACTORS)}{noise}))"""


POLICIES = f"""
SELECT v.*, {rounded(premium(), 2)} AS annual_premium
FROM vehicles v JOIN customers c ON v.customer_id = c.customer_id"""

REQUESTS = f"""
SELECT * EXCLUDE (car_year, l), {YEAR} - car_year AS car_age,
  {rounded(value_of('car_make', f'{YEAR} - car_year', 'kilometers'), 2)} AS estimated_car_value
FROM (SELECT l, l AS request_id,
    CASE WHEN l_returnflag <> 'A' THEN {padded('CUST_', 'l_partkey', 6)} END AS customer_id,
    l_shipdate AS ts, {vehicle_columns('l')},
    18 + (l * 7) % 63 AS age,
    greatest(1, least(18 + (l * 7) % 63 - 16, (l * 13) % 45)) AS years_licensed,
    CASE WHEN l % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
    ({text_list(fv.STATES)})[l_suppkey % 10 + 1] AS state
  FROM (SELECT *, l_orderkey * 10 + l_linenumber AS l FROM lineitem))"""


def risk(age: str = "age", years: str = "years_licensed", claims: str = "claims_history", credit: str = "credit_score") -> str:
    return rounded(
        f"(CASE WHEN {age} < 25 THEN 30 WHEN {age} > 65 THEN 20 ELSE 0 END) + {claims} * 15"
        f" + greatest(0, 40 - {years}) + greatest(0, (700 - {credit}) / 10)", 2)


def tier(credit: str = "credit_score") -> str:
    return (f"CASE WHEN {credit} >= 750 THEN 'Excellent' WHEN {credit} >= 700 THEN 'Good' "
            f"WHEN {credit} >= 650 THEN 'Fair' ELSE 'Poor' END")


def features(people_cte: str, policies_cte: str, as_of: str = AS_OF) -> str:
    return f"""
SELECT c.customer_id, c.age, c.years_licensed, c.claims_history, c.credit_score,
  {risk()} AS risk_score,
  {rounded('c.claims_history / greatest(1, c.years_licensed)', 4)} AS avg_claims_per_year,
  {tier()} AS credit_tier,
  count(p.policy_id) AS total_policies,
  {rounded(f'avg({YEAR} - p.car_year)', 2)} AS avg_car_age,
  {rounded('avg(p.kilometers)', 0)} AS avg_kilometers,
  {rounded('sum(p.estimated_car_value::DECIMAL(18,2))', 2)} AS total_car_value,
  {rounded('avg(p.deductible)', 0)} AS avg_deductible,
  TIMESTAMP '{as_of}' AS updated_at
FROM {people_cte} c LEFT JOIN {policies_cte} p ON c.customer_id = p.customer_id
GROUP BY c.customer_id, c.age, c.years_licensed, c.claims_history, c.credit_score"""


FEATURES = features("customers", "vehicles")

MODEL_INPUT = f"""
SELECT p.policy_id, {YEAR} - p.car_year AS car_age, p.kilometers, p.engine_size, p.estimated_car_value,
  c.age, c.years_licensed, c.claims_history, c.credit_score,
  f.risk_score, f.avg_claims_per_year, f.total_policies, f.avg_car_age, f.avg_kilometers,
  f.total_car_value, f.avg_deductible,
  p.car_make, p.car_model, p.fuel_type, p.transmission, p.coverage_type, c.gender, c.state
FROM vehicles p JOIN customers c ON p.customer_id = c.customer_id JOIN features f ON p.customer_id = f.customer_id"""

BASE = {"customers": CUSTOMERS, "vehicles": VEHICLES}
PRICED = BASE | {"policies": POLICIES}
FEATURED = BASE | {"features": FEATURES}


def hashed(seed, key: str, draw: int) -> str:
    block, part = divmod(draw, 4)
    digest = f"md5('{seed}:' || {key} || ':{block}')"
    return f"('0x' || substr({digest}, {part * 8 + 1}, 8))::BIGINT"


def uniform(seed, key: str, draw: int) -> str:
    return f"(({hashed(seed, key, draw)} + 0.5e0) / 4294967296e0)"


def normal(seed, key: str, draw: int, mean: float, sd: float) -> str:
    return (f"({mean}e0 + {sd}e0 * (sqrt(-2.0e0 * ln({uniform(seed, key, draw)})) * "
            f"cos(6.283185307179586e0 * {uniform(seed, key, draw + 1)})))")


def exponential(seed, key: str, draw: int, scale: float) -> str:
    return f"(-{scale}e0 * ln({uniform(seed, key, draw)}))"


def below(seed, key: str, draw: int, n) -> str:
    return f"floor({uniform(seed, key, draw)} * {n})::BIGINT"


def choice(seed, key: str, draw: int, values: list) -> str:
    literals = text_list(values) if isinstance(values[0], str) else number_list(values)
    return f"({literals})[{below(seed, key, draw, len(values))} + 1]"


def weighted(seed, key: str, draw: int, values: list, weights: list[float]) -> str:
    reached, whens = 0.0, ""
    for value, weight in list(zip(values, weights))[:-1]:
        reached += weight
        whens += f"WHEN {uniform(seed, key, draw)} < {round(reached, 9)}e0 THEN '{value}' "
    return f"(CASE {whens}ELSE '{values[-1]}' END)"


def in_test(seed, key: str) -> str:
    return f"(('0x' || substr(md5('{seed}:' || ({key})::VARCHAR), 1, 8))::BIGINT % 1000 < 200)"
