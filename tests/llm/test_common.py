"""What Python workers keep between tasks."""

from leadloom.llm import common


def test_an_operator_drops_what_others_keep():
    own = common.held("one")
    own["table"] = [1, 2, 3]
    assert common.held("one") is own
    assert common.held("two") == {}
    assert common.held("one") == {}
