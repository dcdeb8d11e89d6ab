from folio.operators import evidence, routing


def test_pdf_profile(spark):
    box = lambda n, c=None: {"x0": 0.0, "y0": 0.0, "x1": float(n), "y1": 10.0, **({"col_count": c} if c else {"xref": 1})}
    left = [50.0] * 5 + [400.0] * 3
    rows = [
        ("a", 1, 100.0, 100.0, "Figure 1 shows\nmore", left, [box(90, 4)], [box(10), box(30), box(100)], 3, 25),
        ("a", 2, 100.0, 100.0, " ", [1.0] * 9, [], [], 0, 0),
        ("b", 1, 100.0, 100.0, "", [], [], [], 0, 0),
    ]
    schema = "job_id string, page_number int, page_width double, page_height double, text string, block_left_edges array<double>, table_boxes array<struct<x0:double,y0:double,x1:double,y1:double,col_count:int>>, image_boxes array<struct<xref:int,x0:double,y0:double,x1:double,y1:double>>, image_ref_count int, drawing_count int"
    got = {r.job_id: r for r in routing.routed(routing.requirements(evidence.pdf_profile(spark.createDataFrame(rows, schema)))).collect()}
    a, b = got["a"], got["b"]
    assert (a.page_or_unit_count, a.text["total_characters"], a.text["pages_or_units_with_text"]) == (2, 20, 1)
    assert (a.tables["count"], a.tables["large_count"], a.tables["max_column_count"]) == (1, 1, 4)
    assert (a.visuals["embedded_image_count"], a.visuals["large_embedded_image_count"], a.visuals["vector_graphics_count"], a.visuals["captioned_visual_count"]) == (3, 1, 25, 1)
    assert a.layout["column_count"] == 2 and (a.engine, a.reason) == ("mineru", "reading_order")
    assert [(c.kind, c.area_ratio) for c in a.visual_candidates] == [("embedded_image", 0.1), ("table", 0.09), ("embedded_image", 0.03), ("vector_graphics", None)]
    assert (b.engine, b.reason, b.visual_candidates) == ("mineru", "ocr", [])
