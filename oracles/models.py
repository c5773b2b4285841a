"""Oracle SQL of the named models (staging, history, dimensions, facts)."""

from oracles.base import with_ctes

_SIMPLE = {
    "b1_stg_users": "stg_users", "b2_stg_parks": "stg_parks", "b3_stg_brigades": "stg_brigades",
    "b4_stg_extra_hours": "stg_extra_hours", "b5_stg_salaries": "stg_salaries", "b6_stg_guards": "stg_guards",
    "b7_stg_requests": "stg_requests", "b8_stg_shift_changes": "stg_shift_changes",
    "b9_stg_assignments": "stg_assignments", "b10_stg_incidents": "stg_incidents",
    "b11_stg_vehicles": "stg_vehicles", "b12_stg_equipment": "stg_equipment",
    "h1_snp_empleado": "snp_empleado", "d2_dim_fecha": "dim_fecha",
    "d3_dim_parque": "dim_parque", "d4_dim_brigada": "dim_brigada", "d5_dim_equipo": "dim_equipo",
    "d6_dim_vehiculo": "dim_vehiculo", "d7_dim_puesto": "dim_puesto", "d8_dim_salario": "dim_salario",
    "d9_dim_empleado": "dim_empleado", "x1_fact_horas_extra": "fact_horas_extra",
    "x2_fact_solicitudes": "fact_solicitudes", "x3_fact_asignaciones": "fact_asignaciones",
    "x4_fact_incidencias": "fact_incidencias",
}

MODELS = {q: with_ctes(f"SELECT * FROM {cte}", cte) for q, cte in _SIMPLE.items()}
