"""The registered queries in SQL, for checking. Common table expressions are put together by name."""

from __future__ import annotations

from cobasket.plans import catalog as c, jobs, staging as st, views

HASH = "CAST('0x' || substr(md5(concat_ws('|', {cols}, '42')), 1, 8) AS BIGINT)"

CTES: dict[str, tuple[list[str], str]] = {
    # ---- views over the order database
    "reviews": ([], """
        SELECT o_custkey AS customer_id, l_partkey AS product_id, l_orderkey AS order_id,
               CAST(floor((l_quantity - 1) / 10) AS INT) + 1 AS rating,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, l_linenumber AS votes, l_linenumber % 3 AS helpful
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "products": (["reviews"], """
        SELECT p_partkey AS asin,
               CASE WHEN p_partkey % 37 <> 0 THEN p_name || ' ' || p_partkey END AS title,
               CASE WHEN p_partkey % 41 <> 0 THEN p_type END AS product_group,
               CASE WHEN p_partkey % 29 = 0 THEN -1 WHEN p_partkey % 31 = 0 THEN 0
                    ELSE CAST(p_partkey * 7919 % 100000 + 1 AS INT) END AS salesrank,
               CASE WHEN p_partkey % 43 <> 0 THEN avg_rating END AS avg_rating,
               CASE WHEN p_partkey % 43 <> 0 THEN total_reviews END AS total_reviews
        FROM part LEFT JOIN (SELECT product_id, round(avg(rating), 1) AS avg_rating, count(*) AS total_reviews
                             FROM reviews GROUP BY 1) ON p_partkey = product_id"""),
    "belongs_to": ([], """
        SELECT p_partkey AS product_id, p_type AS category FROM part
        UNION ALL SELECT p_partkey, p_brand FROM part
        UNION ALL SELECT p_partkey, p_type FROM part
        UNION ALL SELECT p_partkey, 'Size ' || p_size FROM part"""),
    "order_rows": ([], """
        SELECT order_id, product_id
        FROM (SELECT DISTINCT l_orderkey AS order_id, l_partkey AS product_id FROM lineitem)
        QUALIFY count(*) OVER (PARTITION BY order_id) >= 2"""),
    "order_pairs": (["order_rows"], f"""
        SELECT x.product_id AS item1, y.product_id AS item2, count(*) AS support
        FROM order_rows x JOIN order_rows y ON x.order_id = y.order_id AND x.product_id < y.product_id
        GROUP BY 1, 2 HAVING count(*) >= {views.SIMILAR_ORDERS}"""),
    "order_min": (["order_rows"], f"""
        SELECT greatest(2, ceil({st.ORDER_SHARE} * count(DISTINCT order_id))) AS least FROM order_rows"""),
    "order_frequent_pairs": (["order_rows", "order_min"], """
        SELECT x.product_id AS item1, y.product_id AS item2, count(*) AS support
        FROM order_rows x JOIN order_rows y ON x.order_id = y.order_id AND x.product_id < y.product_id
        GROUP BY 1, 2 HAVING count(*) >= (SELECT least FROM order_min)"""),
    "attribute_rows": ([], """
        SELECT order_id, item FROM (
            SELECT l_orderkey AS order_id, p_brand AS item FROM lineitem JOIN part ON p_partkey = l_partkey
            UNION SELECT l_orderkey, 'Size ' || p_size FROM lineitem JOIN part ON p_partkey = l_partkey)
        QUALIFY count(*) OVER (PARTITION BY order_id) >= 2"""),
    "attribute_min": (["attribute_rows"], f"""
        SELECT count(DISTINCT order_id) AS n,
               greatest(2, ceil({st.ATTRIBUTE_SHARE} * count(DISTINCT order_id))) AS least,
               greatest(2, ceil({st.SETS_SHARE} * count(DISTINCT order_id))) AS least_sets FROM attribute_rows"""),
    "attribute_train": (["attribute_rows"], f"""
        SELECT * FROM attribute_rows WHERE {HASH.format(cols='order_id')} % 100 < 70"""),
    "attribute_test": (["attribute_rows"], f"""
        SELECT * FROM attribute_rows WHERE {HASH.format(cols='order_id')} % 100 >= 70"""),
    "train_sets_min": (["attribute_train"], f"""
        SELECT greatest(2, ceil({st.SETS_SHARE} * count(DISTINCT order_id))) AS least FROM attribute_train"""),
    "in2": (["attribute_train", "train_sets_min"], """
        SELECT x.order_id, [x.item, y.item] AS items FROM attribute_train x JOIN attribute_train y
        ON x.order_id = y.order_id AND x.item < y.item"""),
    "tested_sets": (["train_sets", "attribute_test"], """
        SELECT items, n_items, support AS train_support, count(*) AS test_support FROM (
            SELECT items, n_items, support, order_id FROM (SELECT *, unnest(items) AS item FROM train_sets)
            JOIN attribute_test USING (item) GROUP BY ALL HAVING count(*) = n_items) GROUP BY ALL"""),
    "attribute_items": (["attribute_rows", "attribute_min"], """
        SELECT item, count(*) AS support FROM attribute_rows GROUP BY 1
        HAVING count(*) >= (SELECT least FROM attribute_min)"""),
    "attribute_pair_min": (["attribute_rows"], f"""
        SELECT greatest(1, ceil({st.SETS_SHARE} * count(DISTINCT order_id))) AS least FROM attribute_rows"""),
    "attribute_pairs": (["attribute_rows", "attribute_pair_min"], """
        SELECT x.item AS item1, y.item AS item2, count(*) AS support
        FROM attribute_rows x JOIN attribute_rows y ON x.order_id = y.order_id AND x.item < y.item
        GROUP BY 1, 2 HAVING count(*) >= (SELECT least FROM attribute_pair_min)"""),
    "attribute_pair_items": (["attribute_rows", "attribute_pair_min"], """
        SELECT item, count(*) AS support FROM attribute_rows GROUP BY 1
        HAVING count(*) >= (SELECT least FROM attribute_pair_min)"""),
    "alike": (["order_pairs"], "SELECT item1 AS src, item2 AS dst FROM order_pairs"),
    "customers": (["reviews"], "SELECT DISTINCT customer_id FROM reviews"),
    "categories": (["belongs_to"], "SELECT DISTINCT category AS name FROM belongs_to"),

    # ---- what the text records hold
    "listed": ([], """
        SELECT l_orderkey * 10 + l_linenumber AS id, 'P' || l_partkey AS asin, l_partkey AS k, l_linenumber AS line,
               l_suppkey AS supplier, o_custkey AS customer, o_orderdate, p_type, p_brand, p_size,
               CAST(floor((l_quantity - 1) / 10) AS INT) + 1 AS stars,
               CASE WHEN l_partkey % 37 = 0 THEN NULL WHEN l_partkey % 5 = 0 THEN p_name || ': vol ' || l_partkey
                    ELSE p_name || ' ' || l_partkey END AS title,
               CASE WHEN l_partkey % 41 <> 0 THEN p_type END AS product_group,
               CASE WHEN l_partkey % 29 = 0 THEN 0 WHEN l_partkey % 31 <> 0 THEN l_partkey * 7919 % 100000 + 1
               END AS salesrank,
               CASE WHEN l_linenumber % 3 = 0 THEN [] WHEN l_linenumber % 3 = 1 THEN ['P' || (l_partkey + 1)]
                    ELSE ['P' || (l_partkey + 1), 'P' || (l_partkey + l_suppkey)] END AS similar_to,
               CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 7 THEN []
                    ELSE [CASE WHEN l_suppkey % 4 = 0 THEN [p_type, p_brand, ''] ELSE [p_type, p_brand] END,
                          [p_type, 'Size ' || p_size]] END AS paths,
               CASE l_linenumber WHEN 6 THEN NULL WHEN 4 THEN 0 ELSE l_linenumber END AS total_reviews,
               CASE l_linenumber WHEN 6 THEN NULL WHEN 4 THEN 0 ELSE 2 END AS downloaded_reviews,
               CAST(CASE l_linenumber WHEN 6 THEN NULL WHEN 4 THEN 0 ELSE stars END AS DOUBLE) AS avg_rating
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""),
    "listed_reviews": (["listed"], """
        SELECT id, asin, 0 AS position, strftime(o_orderdate, '%Y-%-m-%-d') AS date, 'C' || customer AS customer,
               stars AS rating, line AS votes, line % 3 AS helpful FROM listed WHERE line <> 6
        UNION ALL SELECT id, asin, 1, '2001-2-3', 'C' || (customer + 1), 6 - stars, supplier, line % 3
        FROM listed WHERE line <> 6 AND supplier % 2 = 0"""),
    "n_reviewed": (["listed_reviews"], """
        SELECT customer AS customer_id, asin AS product_id, rating, date, votes, helpful FROM listed_reviews"""),
    "n_similar": (["listed"], "SELECT asin AS src, unnest(similar_to) AS dst FROM listed"),
    "n_belongs_to": (["listed"], """
        SELECT asin AS product_id, unnest(flatten(paths)) AS category FROM listed WHERE paths IS NOT NULL"""),
    "n_customers": (["n_reviewed"], "SELECT DISTINCT customer_id FROM n_reviewed"),
    "n_categories": (["n_belongs_to"], "SELECT DISTINCT category AS name FROM n_belongs_to"),
    "c_products": (["listed"], """
        SELECT asin, title, product_group, salesrank, avg_rating, total_reviews FROM listed
        QUALIFY row_number() OVER (PARTITION BY asin ORDER BY id, title NULLS FIRST, product_group NULLS FIRST,
            salesrank NULLS FIRST, avg_rating NULLS FIRST, total_reviews NULLS FIRST) = 1"""),
    "c_categories": (["n_categories"], "SELECT name FROM n_categories WHERE name <> ''"),
    "c_similar": (["n_similar", "c_products"], """
        SELECT * FROM n_similar WHERE src IN (SELECT asin FROM c_products) AND dst IN (SELECT asin FROM c_products)"""),
    "c_belongs_to": (["n_belongs_to"], "SELECT * FROM n_belongs_to WHERE category <> ''"),
    "strays": (["n_reviewed"], """
        SELECT CASE WHEN votes % 7 = 0 THEN 'X' || customer_id ELSE customer_id END AS customer_id,
               CASE WHEN votes % 5 = 0 THEN 'X' || product_id ELSE product_id END AS product_id,
               rating, date, votes, helpful FROM n_reviewed"""),

    # ---- baskets and patterns
    "basket_rows": (["reviews"], """
        SELECT customer_id, product_id FROM (SELECT DISTINCT customer_id, product_id FROM reviews)
        QUALIFY count(*) OVER (PARTITION BY customer_id) >= 2"""),
    "capped_rows": (["reviews"], f"""
        SELECT customer_id, product_id FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY product_id) AS n
            FROM (SELECT DISTINCT customer_id, product_id FROM reviews)
        ) WHERE n <= {st.MAX_ITEMS} QUALIFY count(*) OVER (PARTITION BY customer_id) >= 2"""),
    "n_baskets": (["basket_rows"], f"""
        SELECT count(DISTINCT customer_id) AS n,
               greatest(2, ceil({st.CUSTOMER_SHARE} * count(DISTINCT customer_id))) AS least FROM basket_rows"""),
    "items": (["basket_rows", "n_baskets"], """
        SELECT product_id AS item, count(*) AS support FROM basket_rows GROUP BY 1
        HAVING count(*) >= (SELECT least FROM n_baskets)"""),
    "pairs": (["basket_rows", "n_baskets"], """
        SELECT x.product_id AS item1, y.product_id AS item2, count(*) AS support
        FROM basket_rows x JOIN basket_rows y ON x.customer_id = y.customer_id AND x.product_id < y.product_id
        GROUP BY 1, 2 HAVING count(*) >= (SELECT least FROM n_baskets)"""),
    "ranked": (["pairs", "n_baskets"], """
        SELECT row_number() OVER (ORDER BY support DESC, item1, item2) AS rank, item1, item2, support,
               support / n AS confidence FROM pairs, n_baskets"""),
    "sampled_rows": (["reviews"], f"""
        SELECT customer_id, product_id FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_id
                                         ORDER BY {HASH.format(cols='customer_id, product_id')}, product_id) AS n
            FROM (SELECT DISTINCT customer_id, product_id FROM reviews)
        ) WHERE n <= {st.MAX_ITEMS} QUALIFY count(*) OVER (PARTITION BY customer_id) >= 2"""),
    "split": (["reviews"], f"""
        SELECT *, CASE WHEN {HASH.format(cols='customer_id, product_id, order_id, rating, date, votes, helpful')} % 100
                       < 70 THEN 'train' ELSE 'test' END AS dataset FROM reviews"""),
    "train_rows": (["split"], """
        SELECT customer_id, product_id
        FROM (SELECT DISTINCT customer_id, product_id FROM split WHERE dataset = 'train')
        QUALIFY count(*) OVER (PARTITION BY customer_id) >= 2"""),
    "train_min": (["train_rows"], f"""
        SELECT greatest(2, ceil({st.TRAIN_SHARE} * count(DISTINCT customer_id))) AS least,
               greatest(2, ceil({st.SAMPLED_SHARE} * count(DISTINCT customer_id))) AS least_sampled FROM train_rows"""),
    "train_pairs": (["train_rows"], """
        SELECT x.product_id AS item1, y.product_id AS item2, count(*) AS support
        FROM train_rows x JOIN train_rows y ON x.customer_id = y.customer_id AND x.product_id < y.product_id
        GROUP BY 1, 2"""),
    "validated": (["split", "train_pairs", "train_min"], f"""
        SELECT item1, item2, train_support, count(*) AS test_support, train_support + count(*) AS total_support
        FROM (SELECT item1, item2, support AS train_support FROM train_pairs
              WHERE support >= (SELECT least FROM train_min))
        JOIN (SELECT DISTINCT customer_id, product_id FROM split WHERE dataset = 'test') x ON x.product_id = item1
        JOIN (SELECT DISTINCT customer_id, product_id FROM split WHERE dataset = 'test') y
          ON y.product_id = item2 AND y.customer_id = x.customer_id
        GROUP BY 1, 2, 3 HAVING count(*) >= {c.TEST_MIN}"""),
    "samples": (["pairs", "reviews"], """
        SELECT item1, item2, customer_id, rating1, rating2 FROM (
            SELECT item1, item2, x.customer_id, x.rating AS rating1, y.rating AS rating2,
                   row_number() OVER (PARTITION BY item1, item2 ORDER BY x.customer_id, x.rating, y.rating) AS n
            FROM pairs JOIN reviews x ON x.product_id = item1
            JOIN reviews y ON y.product_id = item2 AND y.customer_id = x.customer_id) WHERE n <= 10"""),
    "served": (["ranked", "samples", "products"], """
        SELECT rank, CAST(item1 AS VARCHAR) AS asin1, CAST(item2 AS VARCHAR) AS asin2,
               coalesce(a.title, 'Unknown') AS title1, coalesce(b.title, 'Unknown') AS title2,
               a.avg_rating AS "avgRating1", b.avg_rating AS "avgRating2", support, confidence, samples, ratings
        FROM ranked LEFT JOIN products a ON a.asin = item1 LEFT JOIN products b ON b.asin = item2
        LEFT JOIN (SELECT item1, item2,
                          string_agg(customer_id || ':' || rating1 || ':' || rating2, ';'
                                     ORDER BY CAST(customer_id AS VARCHAR), rating1, rating2) AS samples,
                          list({'c': CAST(customer_id AS VARCHAR), 'r1': rating1, 'r2': rating2}
                               ORDER BY CAST(customer_id AS VARCHAR), rating1, rating2) AS ratings
                   FROM samples GROUP BY 1, 2) USING (item1, item2)"""),
    "similar_support": (["alike", "products", "reviews"], """
        SELECT a.asin AS asin1, a.title AS title1, a.total_reviews AS reviews1,
               b.asin AS asin2, b.title AS title2, b.total_reviews AS reviews2, count(DISTINCT x.customer_id) AS support
        FROM alike JOIN products a ON a.asin = src JOIN products b ON b.asin = dst
        JOIN reviews x ON x.product_id = src
        JOIN reviews y ON y.product_id = dst AND y.customer_id = x.customer_id
        WHERE a.total_reviews >= 3 AND b.total_reviews >= 3
        GROUP BY ALL HAVING count(DISTINCT x.customer_id) >= 3"""),
    "similar_item": (["similar_support"], """
        SELECT asin, min(place) AS place, max(title) AS title, max(support) AS support FROM (
            SELECT asin1 AS asin, title1 AS title, reviews1 AS support,
                   2 * row_number() OVER (ORDER BY support DESC, asin1, asin2) AS place FROM similar_support
            UNION ALL
            SELECT asin2, title2, reviews2, 2 * row_number() OVER (ORDER BY support DESC, asin1, asin2) + 1
            FROM similar_support) GROUP BY 1"""),
    # Subsets of a basket, grown along frequent pairs, then counted.
    "order_subsets": (["order_rows", "order_frequent_pairs"], """
        SELECT order_id, [product_id] AS items, product_id AS last FROM order_rows
        UNION ALL
        SELECT s.order_id, list_append(s.items, y.product_id), y.product_id FROM order_subsets s
        JOIN order_rows y ON y.order_id = s.order_id AND y.product_id > s.last
        JOIN order_frequent_pairs p ON p.item1 = s.last AND p.item2 = y.product_id"""),
    "order_sets": (["order_subsets", "order_min"], """
        SELECT items, len(items) AS n_items, count(*) AS support FROM order_subsets GROUP BY 1
        HAVING count(*) >= (SELECT least FROM order_min)"""),

    # ---- what the dirty text holds
    "soiled": (["listed"], r"""
        SELECT l.* REPLACE (
               CASE line WHEN 3 THEN NULL ELSE id END AS id,
               CASE line WHEN 1 THEN '"' || p_name || '", \ ' || k || ' "' WHEN 2 THEN p_name || ' ' || k ELSE title END AS title,
               CASE line WHEN 5 THEN NULL ELSE total_reviews END AS total_reviews,
               CASE line WHEN 5 THEN 3.0 ELSE avg_rating END AS avg_rating,
               CASE line WHEN 1 THEN [['"' || l.p_type || '"', 'a, "b" \']] ELSE paths END AS paths),
               CASE WHEN line = 6 THEN 0 WHEN supplier % 2 = 0 THEN 2 ELSE 1 END AS n_reviews
        FROM listed l JOIN part ON p_partkey = k"""),
    "later_products": (["products"], """
        SELECT * REPLACE (CASE WHEN asin % 23 = 0 THEN 'changed' ELSE title END AS title) FROM products
        WHERE asin % 19 <> 0"""),
}


# Sets of brands and sizes of an order, which has 7 lines at most and so 14 of them: the occurrences of each size are those
# of frequent sets of the size before with one item more.
LARGEST_SET = 14
for size in range(2, LARGEST_SET + 1):
    if size > 2:
        CTES[f"in{size}"] = ([f"in{size - 1}", f"sets{size - 1}", "attribute_train"], f"""
        SELECT order_id, list_append(items, item) AS items FROM in{size - 1} SEMI JOIN sets{size - 1} USING (items)
        JOIN attribute_train USING (order_id) WHERE item > items[-1]""")
    CTES[f"sets{size}"] = ([f"in{size}", "train_sets_min"], f"""
        SELECT items, count(*) AS support FROM in{size} GROUP BY 1
        HAVING count(*) >= (SELECT least FROM train_sets_min)""")
CTES["train_sets"] = ([f"sets{size}" for size in range(2, LARGEST_SET + 1)], f"""
        SELECT items, len(items) AS n_items, support FROM (
            {" UNION ALL ".join(f"SELECT * FROM sets{size}" for size in range(2, LARGEST_SET + 1))})""")


def _sql(names: list[str], body: str) -> str:
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in done:
            needs, text = CTES[name]
            for need in needs:
                add(need)
            done[name] = text

    for name in names:
        add(name)
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in done.items())
    return f"WITH RECURSIVE {ctes}\n{body}" if ctes else body


_LISTED = "asin, title, product_group, avg_rating, total_reviews, salesrank"
_FORM_ORDER = "ORDER BY avg_rating DESC, total_reviews DESC, asin"
_OPEN_ORDER = "ORDER BY avg_rating DESC NULLS FIRST, total_reviews DESC NULLS FIRST, asin"
_TOP = f"WHERE rank <= {c.TOP}"
_SERVED = ('rank, asin1, asin2, title1, title2, "avgRating1", "avgRating2", support, '
           "round(confidence, 6) AS confidence, coalesce(samples, '') AS samples")

ORACLES: dict[str, tuple[list[str], str]] = {
    "parse_records": (["listed"], """
        SELECT asin, count(*) AS n_records, min(id) AS first_id, max(id) AS last_id FROM listed GROUP BY 1"""),
    "parse_products": (["listed"], """
        SELECT id, asin, title, product_group, salesrank, total_reviews, downloaded_reviews, avg_rating FROM listed"""),
    "parse_similar": (["listed"], """
        SELECT id, asin, array_to_string(similar_to, ',') AS similar FROM listed"""),
    "parse_categories": (["listed"], """
        SELECT id, asin, array_to_string([array_to_string(p, '/') FOR p IN paths], ';') AS categories
        FROM listed"""),
    "parse_reviews": (["listed_reviews"], """
        SELECT *, CAST(CAST(strptime(date, '%Y-%-m-%-d') AS DATE) AS VARCHAR) AS day FROM listed_reviews"""),
    "parse_nested": (["listed", "listed_reviews"], """
        SELECT l.id, l.asin, title, len(similar_to) AS n_similar, len(paths) AS n_paths,
               CASE WHEN line = 6 THEN 0 WHEN supplier % 2 = 0 THEN 2 ELSE 1 END AS n_reviews,
               CASE WHEN line = 6 THEN '' ELSE 'C' || customer || ':' || stars
                    || CASE WHEN supplier % 2 = 0 THEN ';C' || (customer + 1) || ':' || (6 - stars) ELSE '' END
               END AS ratings FROM listed l"""),
    "norm_products": (["listed"], """
        SELECT id, asin, title, product_group, salesrank, avg_rating, total_reviews FROM listed"""),
    "norm_similar": (["n_similar"], "SELECT * FROM n_similar"),
    "norm_belongs_to": (["n_belongs_to"], "SELECT * FROM n_belongs_to"),
    "norm_reviews": (["n_reviewed"], "SELECT * FROM n_reviewed"),
    "norm_customers": (["n_customers"], "SELECT * FROM n_customers ORDER BY 1"),
    "norm_categories": (["n_categories"], "SELECT * FROM n_categories ORDER BY 1"),
    "clean_products": (["c_products"], "SELECT * FROM c_products"),
    "clean_customers": (["n_customers"], "SELECT * FROM n_customers"),
    "clean_categories": (["c_categories"], "SELECT * FROM c_categories"),
    "clean_similar": (["c_similar"], "SELECT * FROM c_similar"),
    "clean_belongs_to": (["c_belongs_to"], "SELECT * FROM c_belongs_to"),
    "clean_reviews": (["strays"], """
        SELECT * FROM strays WHERE customer_id NOT LIKE 'X%' AND product_id NOT LIKE 'X%'"""),
    "clean_rejects": (["listed", "n_belongs_to", "n_similar", "c_products", "n_categories", "strays"], """
        SELECT * FROM (
            SELECT 'products' AS table_name, 'duplicate key' AS reason, count(*) - count(DISTINCT asin) AS n_rows
            FROM listed
            UNION ALL SELECT 'categories', 'empty key', count(*) FROM n_categories WHERE name = ''
            UNION ALL SELECT 'belongs_to', 'unknown category', count(*) FROM n_belongs_to WHERE category = ''
            UNION ALL SELECT 'similar', 'unknown dst', count(*) FROM n_similar
                      WHERE dst NOT IN (SELECT asin FROM c_products)
            UNION ALL SELECT 'reviewed', 'unknown customer_id', count(*) FROM strays WHERE customer_id LIKE 'X%'
            UNION ALL SELECT 'reviewed', 'unknown product_id', count(*) FROM strays
                      WHERE customer_id NOT LIKE 'X%' AND product_id LIKE 'X%') WHERE n_rows > 0"""),
    "load_products": (["c_products"], "SELECT * FROM c_products"),
    "load_products_defaults": (["c_products"], """
        SELECT asin, title, product_group, coalesce(salesrank, -1) AS salesrank, coalesce(avg_rating, 0) AS avg_rating,
               CAST(coalesce(total_reviews, 0) AS BIGINT) AS total_reviews FROM c_products"""),
    "load_products_nulls": (["c_products"], """
        SELECT * REPLACE (CAST(total_reviews AS BIGINT) AS total_reviews) FROM c_products"""),
    "load_customers": (["n_customers"], """
        SELECT * FROM n_customers UNION ALL SELECT * FROM n_customers WHERE customer_id LIKE '%7'"""),
    "parse_rejects": (["soiled"], """
        SELECT NULL::BIGINT AS id, NULL::VARCHAR AS asin, 'no field line' AS reason,
               '# dump' || chr(10) || 'total items: 12' AS text FROM soiled WHERE supplier % 7 = 0
        UNION ALL SELECT id, asin, 'unreadable id', 'Id:   n/a' FROM soiled WHERE line = 3
        UNION ALL SELECT id, asin, 'unreadable totals', 'reviews: total: many  downloaded: 2  avg rating: 3'
                  FROM soiled WHERE line = 5
        UNION ALL SELECT id, asin, 'unreadable review line', '2000-1-1  cutomer: C1  rating: x  votes: 1  helpful: 0'
                  FROM soiled WHERE supplier % 3 = 0 AND line <> 6"""),
    "parse_counts": (["soiled"], """
        SELECT * FROM (
            SELECT 'block' AS part, NULL AS reason, count(*) AS n_rows FROM soiled
            UNION ALL SELECT 'block', 'no field line', count(*) FROM soiled WHERE supplier % 7 = 0
            UNION ALL SELECT 'review line', NULL, CAST(sum(n_reviews) AS BIGINT) FROM soiled
            UNION ALL SELECT 'review line', 'unreadable review line', count(*) FROM soiled
                      WHERE supplier % 3 = 0 AND line <> 6
            UNION ALL SELECT 'field', 'unreadable id', count(*) FROM soiled WHERE line = 3
            UNION ALL SELECT 'field', 'unreadable totals', count(*) FROM soiled WHERE line = 5) WHERE n_rows > 0"""),
    "parse_dirty": (["soiled"], """
        SELECT id, asin, title, total_reviews, downloaded_reviews, avg_rating,
               array_to_string([array_to_string(p, '/') FOR p IN paths], ';') AS categories, n_reviews FROM soiled"""),
    "dirty_products_csv": (["soiled"], """
        SELECT asin, title, product_group, salesrank, avg_rating, CAST(total_reviews AS BIGINT) AS total_reviews
        FROM soiled"""),
    "dirty_categories_csv": (["soiled"], """
        SELECT product_id, nullif(category, '') AS category FROM (
            SELECT asin AS product_id, unnest(flatten(paths)) AS category FROM soiled WHERE paths IS NOT NULL)"""),
    "snapshot_differences": (["products", "alike", "reviews"], """
        SELECT 'Product' AS label, CAST(asin AS VARCHAR) AS key, 'removed' AS change, 1 AS n_left, 0 AS n_right
        FROM products WHERE asin % 19 = 0
        UNION ALL SELECT 'Product', CAST(asin AS VARCHAR), 'changed', 1, 1 FROM products WHERE asin % 19 <> 0 AND asin % 23 = 0
        UNION ALL SELECT 'Category', 'New 0', 'added', 0, 1
        UNION ALL SELECT 'SIMILAR', src || '|' || dst, 'removed', 1, 0 FROM alike WHERE src % 3 = 0
        UNION ALL SELECT 'REVIEWED', customer_id || '|' || product_id, 'changed', count(*),
                         count(*) + count(*) FILTER (customer_id % 50 = 1 AND votes = 2)
                  FROM reviews GROUP BY customer_id, product_id
                  HAVING count(*) FILTER (customer_id % 40 = 0 AND votes = 1 OR customer_id % 50 = 1 AND votes = 2) > 0"""),
    "replace_graph": (["products", "customers", "categories", "belongs_to", "alike", "reviews"], """
        SELECT label, unnest([n, n + more]) AS n_rows, unnest(['before', 'current']) AS snapshot FROM (
            SELECT 'Product' AS label, count(*) AS n, -count(*) FILTER (asin % 19 = 0) AS more FROM products
            UNION ALL SELECT 'Customer', count(*), 0 FROM customers
            UNION ALL SELECT 'Category', count(*), 1 FROM categories
            UNION ALL SELECT 'BELONGS_TO', count(*), 0 FROM belongs_to
            UNION ALL SELECT 'SIMILAR', count(*), -count(*) FILTER (src % 3 = 0) FROM alike
            UNION ALL SELECT 'REVIEWED', count(*), count(*) FILTER (customer_id % 50 = 1 AND votes = 2) FROM reviews)"""),
    "scan_reviews_by_product": (["reviews", "products"], """
        SELECT customer_id AS rel_customer_id, product_id AS rel_product_id, rating AS rel_rating, date AS rel_date,
               votes AS rel_votes, helpful AS rel_helpful, asin AS node_asin, title AS node_title,
               product_group AS node_product_group, salesrank AS node_salesrank, avg_rating AS node_avg_rating,
               total_reviews AS node_total_reviews FROM reviews JOIN products ON asin = product_id"""),
    "merge_categories": (["categories", "n_categories"], """
        SELECT name FROM categories
        UNION SELECT name FROM n_categories"""),
    "resolve_belongs_to": (["belongs_to"], "SELECT * FROM belongs_to"),
    "resolve_similar": (["alike", "products"], """
        SELECT src, dst FROM alike JOIN products a ON a.asin = src JOIN products b ON b.asin = dst"""),
    "resolve_reviews": (["reviews", "products"], """
        SELECT customer_id, product_id, rating, date, votes, helpful FROM reviews JOIN products ON asin = product_id"""),
    "counts_by_label": (["products", "customers", "categories"], """
        SELECT 'Product' AS label, count(*) AS n_rows FROM products
        UNION ALL SELECT 'Customer', count(*) FROM customers
        UNION ALL SELECT 'Category', count(*) FROM categories ORDER BY label"""),
    "verify_counts": (["products", "customers", "categories", "belongs_to", "alike", "reviews"], """
        SELECT 'Product' AS label, count(*) AS n_rows FROM products
        UNION ALL SELECT 'Customer', count(*) FROM customers
        UNION ALL SELECT 'Category', count(*) FROM categories
        UNION ALL SELECT 'BELONGS_TO', count(*) FROM belongs_to
        UNION ALL SELECT 'SIMILAR', count(*) FROM alike
        UNION ALL SELECT 'REVIEWED', count(*) FROM reviews"""),
    "compare_snapshots": (["listed", "c_products", "n_customers", "n_categories", "c_categories", "n_belongs_to",
                           "c_belongs_to", "n_similar", "c_similar", "n_reviewed"], """
        SELECT *, n_left = n_right AS same_count, n_left = n_right AS same_rows FROM (
            SELECT 'Product' AS label, (SELECT count(*) FROM listed) AS n_left,
                   (SELECT count(*) FROM c_products) AS n_right
            UNION ALL SELECT 'Customer', (SELECT count(*) FROM n_customers), (SELECT count(*) FROM n_customers)
            UNION ALL SELECT 'Category', (SELECT count(*) FROM n_categories), (SELECT count(*) FROM c_categories)
            UNION ALL SELECT 'BELONGS_TO', (SELECT count(*) FROM n_belongs_to), (SELECT count(*) FROM c_belongs_to)
            UNION ALL SELECT 'SIMILAR', (SELECT count(*) FROM n_similar), (SELECT count(*) FROM c_similar)
            UNION ALL SELECT 'REVIEWED', (SELECT count(*) FROM n_reviewed), (SELECT count(*) FROM n_reviewed))"""),
    "compare_changed_copy": (["products", "customers", "categories", "belongs_to", "alike", "reviews"], """
        SELECT label, n AS n_left, n AS n_right, true AS same_count,
               label IN ('Customer', 'Category', 'BELONGS_TO') OR n = 0 AS same_rows FROM (
            SELECT 'Product' AS label, count(*) AS n FROM products
            UNION ALL SELECT 'Customer', count(*) FROM customers
            UNION ALL SELECT 'Category', count(*) FROM categories
            UNION ALL SELECT 'BELONGS_TO', count(*) FROM belongs_to
            UNION ALL SELECT 'SIMILAR', count(*) FROM alike
            UNION ALL SELECT 'REVIEWED', count(*) FROM reviews)"""),
    "load_relationships": (["alike", "products"], """
        SELECT a.asin AS source_asin, a.title AS source_title, a.product_group AS source_product_group,
               a.salesrank AS source_salesrank, a.avg_rating AS source_avg_rating,
               a.total_reviews AS source_total_reviews,
               b.asin AS target_asin, b.title AS target_title, b.product_group AS target_product_group,
               b.salesrank AS target_salesrank, b.avg_rating AS target_avg_rating,
               b.total_reviews AS target_total_reviews
        FROM alike JOIN products a ON a.asin = src JOIN products b ON b.asin = dst"""),
    "load_reviews": (["reviews"], "SELECT customer_id, product_id, rating FROM reviews"),
    "load_reviews_dataset": (["reviews"], """
        SELECT customer_id, product_id, rating,
               CASE votes WHEN 1 THEN 'train' WHEN 2 THEN 'test' END AS dataset FROM reviews"""),
    "read_typed_csv": (["n_reviewed"], """
        SELECT customer_id, product_id, CAST(rating AS BIGINT) AS rating, date, CAST(votes AS BIGINT) AS votes,
               CAST(helpful AS BIGINT) AS helpful FROM n_reviewed"""),
    "write_graph_csv": (["c_products", "n_customers", "c_categories", "c_belongs_to", "c_similar", "n_reviewed"], """
        SELECT 'Product' AS label, count(*) AS n_rows FROM c_products
        UNION ALL SELECT 'Customer', count(*) FROM n_customers
        UNION ALL SELECT 'Category', count(*) FROM c_categories
        UNION ALL SELECT 'BELONGS_TO', count(*) FROM c_belongs_to
        UNION ALL SELECT 'SIMILAR', count(*) FROM c_similar
        UNION ALL SELECT 'REVIEWED', count(*) FROM n_reviewed
        UNION ALL SELECT 'RATING', CAST(sum(rating) AS BIGINT) FROM n_reviewed"""),
    "search_form_default": (["products"], f"""
        SELECT {_LISTED} FROM products WHERE title IS NOT NULL AND product_group IS NOT NULL
          AND avg_rating IS NOT NULL AND total_reviews > 0 {_FORM_ORDER} LIMIT 20"""),
    "search_form_bounds": (["products"], f"""
        SELECT {_LISTED} FROM products WHERE title IS NOT NULL AND product_group = 'ECONOMY'
          AND avg_rating BETWEEN 2.5 AND 3.5 AND total_reviews BETWEEN 20 AND 45 AND salesrank BETWEEN -1 AND 60000
        {_FORM_ORDER} LIMIT 50"""),
    "search_conditions": (["products"], f"""
        SELECT {_LISTED} FROM products WHERE avg_rating BETWEEN 2.8 AND 3.4 AND total_reviews >= 25
          AND product_group = 'STANDARD' AND salesrank <= 70000 AND salesrank > 0 {_OPEN_ORDER} LIMIT 25"""),
    "search_all": (["products"], f"SELECT {_LISTED} FROM products {_OPEN_ORDER} LIMIT 100"),
    "preset_high_rated": (["products"], f"""
        SELECT {_LISTED} FROM products WHERE avg_rating >= 3.0 AND total_reviews >= 30 {_OPEN_ORDER} LIMIT 10"""),
    "preset_books": (["products"], f"""
        SELECT {_LISTED} FROM products WHERE product_group = 'ECONOMY' AND avg_rating >= 3.0
          AND salesrank <= 50000 AND salesrank > 0 {_OPEN_ORDER} LIMIT 10"""),
    "preset_music": (["products"], f"""
        SELECT {_LISTED} FROM products WHERE product_group = 'PROMO' AND avg_rating >= 3.0 AND total_reviews >= 30
        {_OPEN_ORDER} LIMIT 10"""),
    "filter_high_rated": (["products"], "SELECT * FROM products WHERE avg_rating >= 3.0 AND total_reviews >= 30"),
    "top_products": (["products"], """
        SELECT * FROM products WHERE total_reviews > 0 ORDER BY total_reviews DESC, asin LIMIT 100"""),
    "search_listing": (["products"], f"""
        SELECT row_number() OVER ({_OPEN_ORDER}) AS position, asin,
               substr(CASE WHEN title IS NULL OR title = '' THEN 'Unknown' ELSE title END, 1, 60) AS title,
               coalesce(product_group, 'Unknown') AS product_group,
               CASE WHEN avg_rating IS NULL OR avg_rating = 0 THEN 'N/A' ELSE CAST(avg_rating AS VARCHAR) END AS rating,
               coalesce(total_reviews, 0) AS reviews,
               CASE WHEN salesrank IS NULL OR salesrank = 0 THEN 'N/A' ELSE CAST(salesrank AS VARCHAR) END AS salesrank
        FROM (SELECT * FROM products {_OPEN_ORDER} LIMIT 60)"""),
    "active_customer_products": (["reviews"], """
        SELECT product_id, count(DISTINCT customer_id) AS active_customers FROM reviews
        WHERE customer_id IN (SELECT customer_id FROM reviews GROUP BY 1 HAVING count(*) >= 40)
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25"""),
    "category_analysis": (["belongs_to", "products"], """
        SELECT category, count(*) AS n_products, round(avg(avg_rating), 6) AS mean_rating
        FROM belongs_to JOIN products ON asin = product_id GROUP BY 1"""),
    "top_categories": (["belongs_to"], """
        SELECT category, count(*) AS n_products FROM belongs_to GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50"""),
    "top_reviewers": (["reviews"], """
        SELECT customer_id, count(*) AS n_reviews FROM reviews WHERE rating >= 4 GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 100"""),
    "similarity_network": (["alike", "products"], """
        SELECT a.asin AS asin1, a.title AS title1, b.asin AS asin2, b.title AS title2
        FROM alike JOIN products a ON a.asin = src JOIN products b ON b.asin = dst
        WHERE a.total_reviews > 30 AND b.total_reviews > 30 ORDER BY 1, 3 LIMIT 500"""),
    "similar_pair_support": (["similar_support"], "SELECT * FROM similar_support"),
    "similar_items": (["similar_item"], """
        SELECT row_number() OVER (ORDER BY place) AS position, asin, title, support FROM similar_item"""),
    "similar_rules": (["similar_support", "similar_item"], """
        SELECT antecedent, consequent, round(support / n1, 6) AS confidence,
               round((support / n1) / (n2 / (SELECT sum(support) FROM similar_item)), 6) AS lift, support FROM (
            SELECT asin1 AS antecedent, asin2 AS consequent, reviews1 AS n1, reviews2 AS n2, support
            FROM similar_support
            UNION ALL SELECT asin2, asin1, reviews2, reviews1, support FROM similar_support)
        WHERE n1 > 0 AND n2 > 0"""),
    "baskets": (["capped_rows"], """
        SELECT customer_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY product_id) AS items
        FROM capped_rows GROUP BY 1"""),
    "baskets_sampled_items": (["sampled_rows"], """
        SELECT customer_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY product_id) AS items
        FROM sampled_rows GROUP BY 1"""),
    "sample_baskets": (["capped_rows", "n_baskets"], f"""
        SELECT customer_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY product_id) AS items
        FROM capped_rows, n_baskets
        WHERE n <= {c.SAMPLE_MAX} OR {HASH.format(cols='customer_id')} / CAST(4294967296.0 AS DOUBLE)
                                     < CAST({c.SAMPLE_MAX} AS DOUBLE) / n
        GROUP BY 1"""),
    "train_test_split": (["split"], "SELECT * FROM split"),
    "train_test_split_by_customer": (["reviews"], f"""
        SELECT *, CASE WHEN {HASH.format(cols='customer_id')} % 100 < 70 THEN 'train' ELSE 'test' END AS dataset
        FROM reviews"""),
    "split_preserved": (["split"], """
        SELECT * REPLACE (CASE votes WHEN 1 THEN 'train' WHEN 2 THEN 'test' ELSE dataset END AS dataset) FROM split"""),
    "split_counts": (["split"], "SELECT dataset, count(*) AS n_reviews FROM split GROUP BY 1"),
    "dataset_or_all": (["split"], """
        SELECT *, 'test' AS asked_for FROM split WHERE dataset = 'test'
        UNION ALL SELECT *, 'holdout' FROM split"""),
    "frequent_items": (["items"], "SELECT * FROM items"),
    "frequent_pairs": (["pairs"], "SELECT * FROM pairs"),
    "frequent_itemsets": (["order_sets"], """
        SELECT array_to_string(items, ',') AS items, n_items, support FROM order_sets"""),
    "frequent_pairs_fpgrowth": (["order_frequent_pairs"], "SELECT * FROM order_frequent_pairs"),
    "frequent_triples": (["order_sets"], """
        SELECT items[1] AS item1, items[2] AS item2, items[3] AS item3, support FROM order_sets WHERE n_items = 3"""),
    "association_rules": (["order_rows", "order_sets"], """
        SELECT array_to_string(antecedent, ',') AS antecedent, consequent, round(f / a.support, 6) AS confidence,
               round((f / a.support) / (b.support / n), 6) AS lift, round(f / n, 6) AS support
        FROM (SELECT [x FOR x IN items IF x <> consequent] AS antecedent, consequent, f
              FROM (SELECT items, support AS f, unnest(items) AS consequent FROM order_sets WHERE n_items >= 2))
        JOIN order_sets a ON a.items = antecedent JOIN order_sets b ON b.items = [consequent],
        (SELECT count(DISTINCT order_id) AS n FROM order_rows)
        WHERE f / a.support >= 0.1"""),
    "pair_rules": (["pairs", "items", "n_baskets"], """
        SELECT antecedent, consequent, round(f / a.support, 6) AS confidence,
               round((f / a.support) / (b.support / n), 6) AS lift, round(f / n, 6) AS support
        FROM (SELECT item1 AS antecedent, item2 AS consequent, support AS f FROM pairs
              UNION ALL SELECT item2, item1, support FROM pairs)
        JOIN items a ON a.item = antecedent JOIN items b ON b.item = consequent, n_baskets
        WHERE f / a.support >= 0.1"""),
    "ranked_patterns": (["ranked", "items"], """
        SELECT rank, item1, item2, r.support, round(confidence, 6) AS confidence,
               round(r.support / least(a.support, b.support), 6) AS rule_confidence
        FROM ranked r JOIN items a ON a.item = item1 JOIN items b ON b.item = item2"""),
    "train_patterns": (["train_pairs", "train_min"], """
        SELECT * FROM train_pairs WHERE support >= (SELECT least_sampled FROM train_min)"""),
    "train_rules": (["train_rows", "train_pairs", "train_min"], """
        SELECT antecedent, consequent, round(f / a.support, 6) AS confidence,
               round((f / a.support) / (b.support / n), 6) AS lift, round(f / n, 6) AS support
        FROM (SELECT item1 AS antecedent, item2 AS consequent, support AS f FROM train_pairs
              UNION ALL SELECT item2, item1, support FROM train_pairs)
        JOIN (SELECT product_id, count(*) AS support FROM train_rows GROUP BY 1) a ON a.product_id = antecedent
        JOIN (SELECT product_id, count(*) AS support FROM train_rows GROUP BY 1) b ON b.product_id = consequent,
             (SELECT count(DISTINCT customer_id) AS n FROM train_rows)
        WHERE f >= (SELECT least_sampled FROM train_min) AND f / a.support >= 0.1"""),
    "train_itemsets": (["train_sets"], "SELECT * REPLACE (array_to_string(items, ',') AS items) FROM train_sets"),
    "validate_itemsets": (["tested_sets"], """
        SELECT *, train_support + test_support AS total_support FROM (
            SELECT * REPLACE (array_to_string(items, ',') AS items) FROM tested_sets)"""),
    "write_results": (["split", "validated"], """
        SELECT item1 || ',' || item2 AS products, train_support, test_support, total_support,
               (SELECT count(*) FROM validated) AS num_patterns,
               (SELECT count(*) FROM split WHERE dataset = 'train') AS train_reviews FROM validated"""),
    "attribute_items": (["attribute_items"], "SELECT * FROM attribute_items"),
    "attribute_pairs": (["attribute_pairs"], "SELECT * FROM attribute_pairs"),
    "attribute_triples": (["attribute_rows", "attribute_min"], """
        SELECT x.item AS item1, y.item AS item2, z.item AS item3, count(*) AS support
        FROM attribute_rows x JOIN attribute_rows y ON x.order_id = y.order_id AND x.item < y.item
        JOIN attribute_rows z ON z.order_id = y.order_id AND y.item < z.item
        GROUP BY 1, 2, 3 HAVING count(*) >= (SELECT least_sets FROM attribute_min)"""),
    "attribute_rules": (["attribute_pairs", "attribute_pair_items", "attribute_min"], """
        SELECT antecedent, consequent, round(f / a.support, 6) AS confidence,
               round((f / a.support) / (b.support / n), 6) AS lift, round(f / n, 6) AS support
        FROM (SELECT item1 AS antecedent, item2 AS consequent, support AS f FROM attribute_pairs
              UNION ALL SELECT item2, item1, support FROM attribute_pairs)
        JOIN attribute_pair_items a ON a.item = antecedent
        JOIN attribute_pair_items b ON b.item = consequent, attribute_min
        WHERE f / a.support >= 0.1"""),
    "validate_patterns": (["validated"], "SELECT * FROM validated"),
    "top_validated": (["validated"], "SELECT * FROM validated ORDER BY total_support DESC, item1, item2 LIMIT 10"),
    "mining_stats": (["split", "validated"], """
        SELECT count(*) AS total_reviews, count(*) FILTER (dataset = 'train') AS train_reviews,
               count(*) FILTER (dataset = 'test') AS test_reviews,
               (SELECT count(*) FROM validated) AS num_patterns FROM split"""),
    "sample_customers": (["samples"], "SELECT * FROM samples"),
    "enriched_patterns": (["ranked", "products"], """
        SELECT rank, item1, item2, support, round(confidence, 6) AS confidence,
               coalesce(a.title, 'Unknown') AS title1, a.avg_rating AS avg_rating1,
               coalesce(b.title, 'Unknown') AS title2, b.avg_rating AS avg_rating2
        FROM ranked LEFT JOIN products a ON a.asin = item1 LEFT JOIN products b ON b.asin = item2"""),
    "patterns_nested": (["served"], f"SELECT {_SERVED} FROM served"),
    "write_patterns": (["served"], f"""
        SELECT {_SERVED}, (SELECT count(*) FROM served) AS total_patterns, '{jobs.PAIR_COUNT}' AS algorithm
        FROM served"""),
    "read_patterns": (["served"], f"SELECT {_SERVED} FROM served"),
    "enriched_validated": (["validated", "products"], """
        SELECT item1 || ',' || item2 AS products,
               coalesce(a.title, 'Unknown') || ',' || coalesce(b.title, 'Unknown') AS titles,
               coalesce(a.avg_rating, 0.0) || ',' || coalesce(b.avg_rating, 0.0) AS ratings,
               train_support, test_support, total_support, CAST(0 AS DOUBLE) AS confidence
        FROM validated
        LEFT JOIN products a ON a.asin = item1 LEFT JOIN products b ON b.asin = item2"""),
    "pattern_list": (["served"], """
        SELECT rank, substr(title1, 1, 40) AS title1, substr(title2, 1, 40) AS title2, support,
               printf('%.4f', confidence) AS confidence FROM served"""),
    "top_patterns": (["served"], """
        SELECT rank, support, printf('%.4f', confidence) AS confidence, substr(title1, 1, 60) AS title1,
               coalesce(printf('%.2f', "avgRating1"), 'N/A') AS rating1, substr(title2, 1, 60) AS title2,
               coalesce(printf('%.2f', "avgRating2"), 'N/A') AS rating2, coalesce(len(ratings), 0) AS n_samples
        FROM served WHERE rank <= 10"""),
    "pattern_detail": (["served"], """
        SELECT rank, asin1, title1, asin2, title2, support, printf('%.4f', confidence) AS confidence, position,
               ratings[position].c AS customer_id, printf('%.1f', CAST(ratings[position].r1 AS DOUBLE)) AS rating1,
               printf('%.1f', CAST(ratings[position].r2 AS DOUBLE)) AS rating2
        FROM served, (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INT) AS position)
        WHERE rank = 3 AND position <= len(ratings)"""),
    "pattern_overview": (["ranked"], f"""
        SELECT rank, support, round(confidence * 100, 6) AS confidence_percent FROM ranked {_TOP}"""),
    "rating_distribution": (["ranked", "samples"], f"""
        SELECT rank, product, rating, n_ratings,
               round(100.0 * n_ratings / sum(n_ratings) OVER w, 6) AS percent,
               round(sum(rating * n_ratings) OVER w / sum(n_ratings) OVER w, 6) AS mean_rating
        FROM (SELECT rank, product, CAST(rating AS DOUBLE) AS rating, count(*) AS n_ratings
              FROM (SELECT rank, 1 AS product, rating1 AS rating FROM ranked JOIN samples USING (item1, item2)
                    UNION ALL SELECT rank, 2, rating2 FROM ranked JOIN samples USING (item1, item2))
              GROUP BY 1, 2, 3)
        WINDOW w AS (PARTITION BY rank, product)"""),
}


ORACLES["scan_similar_buckets"] = ORACLES["load_relationships"]


def oracle_sql() -> dict[str, str]:
    return {name: _sql(names, body) for name, (names, body) in ORACLES.items()}
