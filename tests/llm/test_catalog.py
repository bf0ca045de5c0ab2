from voxloom.llm import catalog


def test_one_query_of_each_operator_and_sql_texts():
    assert [k.split("_")[0] for k in catalog.QUERIES] == ["op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10"]
    assert all(isinstance(s, str) and k in catalog.QUERIES for k, s in catalog.ORACLES.items())
