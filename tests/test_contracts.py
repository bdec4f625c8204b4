from logsift.contracts import HYBRID, K8S_LOG, contract_for


def test_contract_lookup():
    assert contract_for("k8s_log") is K8S_LOG
    assert contract_for("hybrid_dataset") is HYBRID
    assert contract_for("unknown") is K8S_LOG


def test_contract_shapes():
    assert len(K8S_LOG.fields) == 13 and len(HYBRID.fields) == 10
    assert K8S_LOG.struct_type().fieldNames()[0] == "timestamp"
    assert HYBRID.get("cpu_usage").nullable and not HYBRID.get("label").nullable
