"""Plain Spark SQL shapes of the headline queries against this library's, timed in turn.

Both sides start from the raw driver tables in one session with the same cores, and the best of the
repeats counts. The plain side cleans with a ``row_number`` window per key and writes each query as one
would by hand: window ranks, all lookup joins, ``count(distinct)``, self joins.

    python tools/baseline.py [sf_dir] [cores] [repeats]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwise.plans.suite import QUERIES  # noqa: E402
from cartwise.session import local_session  # noqa: E402
from cartwise.sources import driver  # noqa: E402
from cartwise.specs import SPECS  # noqa: E402

SHAPES = {
    "dedup_entries": "select * from clean_tb_cartentries",
    "cart_enriched": "select * from enriched",
    "top_products": "select product_id, count(distinct cart_id) n, sum(quantity), sum(total_price) r from items group by product_id order by n desc, r desc, product_id limit 50",
    "top_pairs": """with bp as (select distinct cart_id, product_id from items where product_id is not null)
        select x.product_id a, y.product_id b, count(*) n from bp x join bp y on x.cart_id = y.cart_id and x.product_id < y.product_id
        group by 1, 2 order by n desc, a, b limit 50""",
    "rising_products": """with m as (select product_id, month, count(distinct cart_id) n from items group by product_id, month),
        l as (select *, lag(n) over (partition by product_id order by month) before from m)
        select *, round(100.0 * (n - before) / before, 2) pct from l where n > before order by n - before desc, pct desc, product_id, month limit 50""",
    "first_month": """with f as (select product_id, min(month) month from items where product_id is not null group by product_id)
        select product_id, month, count(distinct cart_id), sum(quantity), sum(total_price) from items join f using (product_id, month) group by product_id, month""",
    "by_state": "select coalesce(state, 'SEM_UF') s, count(distinct cart_id), sum(item_quantity_sum), sum(cart_total_price) from enriched group by 1",
    "product_month": "select product_id, month, count(distinct cart_id), sum(quantity), sum(total_price) from items group by product_id, month order by month, product_id",
    "daily": "select cart_date, count(distinct cart_id), sum(item_quantity_sum), sum(cart_total_price) from enriched group by cart_date order by cart_date",
    "top_carts": """select * from (select * from enriched order by cart_total_price desc nulls last, cart_id limit 50) c left join items i on i.cart_id = c.cart_id
        order by cart_total_price desc, c.cart_id, entry_number""",
    "league_points": """select time_id, time_nome, coalesce(sum(p), 0) from teams left join (
        select mandante_time t, case when mandante_gols > visitante_gols then 3 when mandante_gols = visitante_gols then 1 else 0 end p from matches
        union all select visitante_time, case when mandante_gols < visitante_gols then 3 when mandante_gols = visitante_gols then 1 else 0 end from matches)
        on t = time_id group by time_id, time_nome""",
    "topk_sum_at_least": """select vendedor from (select *, row_number() over (partition by vendedor order by valor desc) r from sales)
        where r <= 3 group by vendedor having sum(valor) >= 290000""",
    "table_counts": " union all ".join(f"select '{t}' t, count(*) from clean_{t}" for t in SPECS),
    "load_metrics": " union all ".join(
        f"select '{t}' t, count(*), count({s.key}), count(distinct {s.key}) from raw_{t}" for t, s in SPECS.items()),
}


def views(spark, sf_dir: str) -> None:
    for name, df in driver.source_tables(spark, sf_dir).items():
        spec = SPECS[name]
        rest = ", ".join(f"{c} nulls last" for c in spec.normalized if c != spec.key)
        typed = df.selectExpr(*[f"cast({c} as {spec.target_type(c)}) as {c}" for c in spec.normalized])
        typed.createOrReplaceTempView(f"raw_{name}")
        spark.sql(f"""select * except (r) from (select *, row_number() over (partition by {spec.key} order by {rest}) r
            from raw_{name} where {spec.key} is not null) where r = 1""").createOrReplaceTempView(f"clean_{name}")
    spark.sql("""select p_order cart_id, pk entry_id, p_product product_id, coalesce(p_quantity, 0) quantity, coalesce(p_totalprice, 0) total_price,
        p_entrynumber entry_number, trunc(createdts, 'month') month from clean_tb_cartentries where p_order is not null""").createOrReplaceTempView("items")
    spark.sql("""select k.pk cart_id, k.createdts created_ts, to_date(k.createdts) cart_date, coalesce(k.p_totalprice, 0) cart_total_price, p_uid, m.p_code,
        p_installments, p_name, p_postalcode, p_isocodeshort state, coalesce(q, 0) item_quantity_sum, coalesce(n, 0) item_count
        from clean_tb_carts k left join (select cart_id, sum(quantity) q, count(*) n from items group by cart_id) t on t.cart_id = k.pk
        left join clean_tb_users u on u.pk = k.p_user left join clean_tb_paymentmodes m on m.pk = k.p_paymentmode
        left join clean_tb_paymentinfos p on p.pk = k.p_paymentinfo left join clean_tb_cmssitelp s on s.itempk = k.p_site
        left join clean_tb_addresses a on a.pk = k.p_paymentaddress left join clean_tb_regions g on g.pk = a.p_region""").createOrReplaceTempView("enriched")
    driver.times(spark, sf_dir).createOrReplaceTempView("teams")
    driver.jogos(spark, sf_dir).createOrReplaceTempView("matches")
    driver.comissoes(spark, sf_dir).createOrReplaceTempView("sales")


def timed(make) -> float:
    t = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cores, repeats = int(sys.argv[2]) if len(sys.argv) > 2 else 8, int(sys.argv[3]) if len(sys.argv) > 3 else 3
    spark = local_session(cores, 8)
    views(spark, sf_dir)
    timed(lambda: spark.sql(SHAPES["top_products"]))
    timed(lambda: QUERIES["top_products"](spark, sf_dir))
    out = {}
    for name, sql in SHAPES.items():
        pairs = [(timed(lambda: spark.sql(sql)), timed(lambda: QUERIES[name](spark, sf_dir))) for _ in range(repeats)]
        plain, own = (round(min(x), 2) for x in zip(*pairs))
        out[name] = {"plain": plain, "own": own, "ratio": round(own / plain, 2)}
        print(name, out[name], flush=True)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
