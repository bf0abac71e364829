"""Both splits are evaluated in one pass."""

import random

from trustfeed.operators import model

SCHEMA = ("post_id string, recommend string, is_test boolean, age bigint, mirrors bigint, collects bigint, comments bigint, "
          "upvotes bigint, downvotes bigint, followship_rank bigint, followship_score double, max_age bigint, max_mirrors bigint, "
          "max_collects bigint, max_comments bigint, post_score double, is_original boolean, is_content_warning boolean, "
          "custom_filters_gardener_flagged boolean, language string, region string, content_warning string, main_content_focus string")


def _rows(n):
    draw = random.Random(5)
    return [(f"p{i}", draw.choice(["YES", "NO", "MAYBE", None]), i % 4 == 0, i % 90, draw.choice([None, 1, 2]), i % 3, i % 5, i % 7, i % 2,
             i % 50, i / n, 90, 2, 3, 5, draw.random(), i % 2 == 0, i % 3 == 0, draw.choice([True, False, None]),
             draw.choice(["en", "de", None]), draw.choice(["US", None]), None, draw.choice(["VIDEO", "IMAGE"])) for i in range(n)]


def test_both_splits_in_one_pass(spark):
    df = spark.createDataFrame(_rows(400), SCHEMA)
    m = model.train(df.where("not is_test"), "rf", num_trees=5, max_depth=3)
    both = model.evaluate_by(m, df)
    for test in (False, True):
        alone = model.evaluate(m, df.where(df["is_test"] == test))
        assert both[test].keys() == alone.keys()
        assert all(abs(both[test][k] - v) < 1e-12 for k, v in alone.items())
    assert model.evaluate_by(m, df.where("not is_test"))[True] == {}
