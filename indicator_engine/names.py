"""The column names a dataset uses.

Every operator takes its columns from a ``Names`` so that the same code serves
any dataset with a key, a year and measures.  The defaults are the published
schema of the layered tables.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Names:
    # keys
    year: str = "ano"
    entity: str = "id_municipio"
    code: str = "codigo_uf"
    region: str = "sigla_uf"
    region_name: str = "nome_uf"
    macro: str = "regiao"
    network: str = "rede"
    # measures
    rate: str = "taxa_alfabetizacao"
    score: str = "media_portugues"
    # wide targets (one column per year: prefix + year) and their long form
    target_prefix: str = "meta_alfabetizacao_"
    target_year: str = "ano_meta"
    target: str = "meta_taxa"
    # integrated table
    current_target: str = "meta_ano_corrente"
    gap: str = "gap_meta"
    reached: str = "atingiu_meta"
    # products
    previous: str = "taxa_ano_anterior"
    change: str = "variacao"
    entities: str = "qtd_municipios"
    mean_rate: str = "taxa_media"
    reached_share: str = "prop_municipios_na_meta"
    # micro-data
    flag_text: str = "alfabetizado"
    raw_score: str = "proficiencia"
    sample_rows: str = "qtd_alunos_amostra"
    sample_score: str = "proficiencia_media"
    sample_share: str = "prop_alfabetizado_amostra"
    # provenance and events
    origin: str = "_arquivo_origem"
    ingested: str = "_ingestao_ts"
    event_time: str = "evento_ts"
    events: str = "eventos"

    @property
    def measures(self) -> tuple[str, str]:
        return (self.rate, self.score)

    @property
    def labels(self) -> tuple[str, str, str]:
        """What the territory lookup adds, in table order."""
        return (self.region, self.region_name, self.macro)

    def target_column(self, year: int) -> str:
        return f"{self.target_prefix}{year}"
