"""Raw CSV entities in the shape of the source, with every awkward case."""

from __future__ import annotations

YEARS = range(2024, 2031)
META = ",".join(f"meta_alfabetizacao_{y}" for y in YEARS)


def targets(*values) -> str:
    return ",".join("" if v is None else str(v) for v in values)


FLAT = targets(*([80.0] * 7))

FILES = {
    "uf.csv": [
        "ano,sigla_uf,serie,rede,taxa_alfabetizacao,media_portugues",
        "2023,SP,2,5,50.0,700",
        "2023,SP,2,5,60.0,710",
        "2024,SP,2,5,,720",
    ],
    "municipio.csv": [
        "ano,id_municipio,serie,rede,taxa_alfabetizacao,media_portugues",
        # two rows of one year
        "2023,3550308,2,3,50.0,700.0",
        "2023,3550308,2,3,60.0,720.0",
        "2024,3550308,2,3,61.0,730.0",
        # a gap year
        "2022,3304557,2,3,40.0,690.0",
        "2024,3304557,2,3,45.5,700.0",
        # no such state
        "2024,9900001,2,3,70.0,750.0",
        # empty rate; rate beyond 100
        "2024,2927408,2,3,,710.0",
        "2024,5300108,2,3,101.0,760.0",
        # a year that is no integer
        "2023.0,1302603,2,3,30.0,650.0",
    ],
    "meta_brasil.csv": [
        f"ano,rede,taxa_alfabetizacao,{META},percentual_participacao",
        f"2023,Pública,55.0,{targets(60, 61, 62, 63, 64, 65, 66)},90",
        f"2024,Pública,56.0,{targets(60.5, 64, 67, 70, 74, 77, 80)},91",
    ],
    "meta_uf.csv": [
        f"ano,sigla_uf,rede,taxa_alfabetizacao,{META},percentual_participacao",
        f"2023,SP,Pública,55.0,{targets(1, 2, 3, 4, 5, 6, 7)},90",
        f"2024,SP,Pública,55.0,{FLAT},90",
        f"2023,RJ,Pública,55.0,{FLAT},90",
    ],
    "meta_municipio.csv": [
        f"ano,id_municipio,rede,taxa_alfabetizacao,{META},nivel_alfabetizacao,percentual_participacao",
        # two base years: the newer one counts
        f"2023,3550308,Municipal,50.0,{targets(99, 99, 99, 99, 99, 99, 99)},2,90",
        f"2024,3550308,Municipal,50.0,{targets(61.0, 62, 63, 64, 65, 66, 67)},2,90",
        # empty target of the observed year
        f"2024,3304557,Municipal,50.0,{targets(None, 50, 51, 52, 53, 54, 55)},2,90",
        # empty base year loses
        f",2927408,Municipal,50.0,{targets(1, 1, 1, 1, 1, 1, 1)},2,90",
        f"2023,2927408,Municipal,50.0,{FLAT},2,90",
        f"2023,5300108,Municipal,50.0,{FLAT},2,90",
    ],
    "alunos.csv": [
        "ano,id_municipio,id_escola,id_aluno,serie,rede,presenca,alfabetizado,proficiencia,peso_aluno",
        "2023,3550308,1,1,2,3,1,1,750.0,1.0",
        "2023,3550308,1,2,2,3,1,Sim,740.0,1.0",
        "2023,3550308,1,3,2,3,1,TRUE,,1.0",
        "2023,3550308,1,4,2,3,1,0,700.0,1.0",
        "2023,3550308,1,5,2,3,1,1.0,710.0,1.0",
        "2024,3550308,1,6,2,3,1,,720.0,1.0",
    ],
}


def write(folder) -> None:
    for name, lines in FILES.items():
        (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
