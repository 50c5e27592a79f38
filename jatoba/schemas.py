"""Declared schemas. Nothing is inferred: inference costs a pass over the data
and would turn the free-form ``value`` field into whatever the sample held."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Field names and order of the exported collections and of the layer tables.

ORGANIZATION_RECORD = """
    id string, _id string, name string, created_at string, updated_at string,
    custom_fields array<struct<value: string, created_at: string, updated_at: string,
                               custom_field: struct<label: string>>>
"""
FUNNEL_RECORD = "name string, deal_stages array<struct<_id: string, name: string>>"
STAGE_RECORD = "id string, name string, created_at string, updated_at string"
DEAL_RECORD = """
    id string, name string, last_activity_at string, interactions bigint, win boolean, closed_at string,
    organization struct<id: string, name: string>, user struct<name: string>,
    deal_stage struct<id: string, name: string>, deal_lost_reason struct<name: string>,
    created_at string, updated_at string
"""
TASK_RECORD = """
    id string, subject string, type string, markup string, done boolean, notes string,
    deal_id string, done_date string, created_at string, date string
"""

BRONZE_ORGANIZATIONS = ["id", "name", "custom_field.label", "value", "created_at_x", "updated_at_x"]
BRONZE_FUNNELS = ["Name", "DealStage_ID", "DealStage_Name"]
BRONZE_STAGES = ["id", "name", "created_at", "updated_at"]
BRONZE_DEALS = [
    "id", "name", "last_activity_at", "interactions", "win", "closed_at",
    "organization.id", "organization.name", "user.name", "deal_stage.id", "deal_stage.name",
    "deal_lost_reason.name", "created_at", "updated_at",
]
BRONZE_TASKS = [
    "id", "subject", "type", "markup", "done", "notes", "deal_id", "done_date", "created_at", "date",
]

SILVER_ORGANIZATIONS = """
    company_id string, name string, created_at timestamp_ntz, updated_at timestamp_ntz, id string,
    cidade string, car_incra string, area_util string, volume_calculado string, proprietario string,
    landviewer string, registro_rural string, google_maps string, dt_log timestamp_ntz, coordenada string
"""
SILVER_DEALS = """
    id string, name string, last_activity_at timestamp_ntz, interactions bigint, win boolean,
    closed_at timestamp_ntz, organization_id string, organization_name string, user_name string,
    stage_id string, stage_name string, lost_reason string, created_at timestamp_ntz,
    updated_at timestamp_ntz, funnel_name string
"""
GOLD = """
    id_organizacao string, nome_organizacao string, cidade string, car_incra string, area_util string,
    volume_calculado string, proprietario string, landviewer string, registro_rural string,
    google_maps string, coordenada_completa string, nome_negociacao string, responsavel string,
    etapa string, motivo_perda string, dt_criacao_negociacao timestamp_ntz,
    dt_atualizacao_negociacao timestamp_ntz, qtde_tarefas bigint, dt_carga timestamp_ntz,
    latitude decimal(38,18), longitude decimal(38,18), ponto struct<srid: int, x: double, y: double>,
    nome_funil string, geom binary
"""

# Custom-field label -> silver column.
CUSTOM_FIELD_COLUMNS = {
    "ID": "id",
    "CIDADE": "cidade",
    "CAR ou INCRA": "car_incra",
    "ÁREA ÚTIL": "area_util",
    "VOLUME CALCULADO": "volume_calculado",
    "PROPRIETÁRIO": "proprietario",
    "LAND VIEWER": "landviewer",
    "REGISTRO RURAL": "registro_rural",
    "GOOGLE MAPS": "google_maps",
    "COORDENADA": "coordenada",
}

# Silver column -> gold column.
GOLD_ORGANIZATION_COLUMNS = {
    "company_id": "company_id",
    "id": "id_organizacao",
    "name": "nome_organizacao",
    "cidade": "cidade",
    "car_incra": "car_incra",
    "area_util": "area_util",
    "volume_calculado": "volume_calculado",
    "proprietario": "proprietario",
    "landviewer": "landviewer",
    "registro_rural": "registro_rural",
    "google_maps": "google_maps",
    "dt_log": "dt_carga",
}
GOLD_DEAL_COLUMNS = {
    "id": "deal",
    "organization_id": "organization_id",
    "name": "nome_negociacao",
    "user_name": "responsavel",
    "stage_name": "etapa",
    "lost_reason": "motivo_perda",
    "created_at": "dt_criacao_negociacao",
    "updated_at": "dt_atualizacao_negociacao",
    "funnel_name": "funnel_name",
}

# Bronze deal column -> silver column, for those that change their name.
SILVER_DEAL_RENAMES = {
    "organization.id": "organization_id",
    "organization.name": "organization_name",
    "user.name": "user_name",
    "deal_stage.id": "stage_id",
    "deal_stage.name": "stage_name",
    "deal_lost_reason.name": "lost_reason",
}
DEAL_TIMES = ["last_activity_at", "closed_at", "created_at", "updated_at"]

# The two funnels that get a gold table.
NEGOTIATION_FUNNEL = "Em Negociação"
CAPTURE_FUNNEL = "Captação Florestal"

PAGE_LIMIT = 200
SRID = 4326


def names(ddl: str) -> list[str]:
    """Column names of a declared schema, in order."""
    return StructType.fromDDL(ddl).names
