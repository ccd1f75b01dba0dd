"""Words that are stored as values in the tables and reports.

Fixed values: `SOURCE` holds the words existing reports filter on, so they are the
default; `ENGLISH` holds the same lists in English. Pass one of the two where a function
takes `words`.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Words:
    # Rejection reasons, in rule order; `duplicate` is decided after the rules.
    negative_total: str
    negative_fare: str
    dropoff_before_pickup: str
    over_24h: str
    outside_period: str
    no_movement: str
    distance_over_200: str
    total_over_1000: str
    duplicate: str
    months: tuple[str, ...]  # January first
    weekdays: tuple[str, ...]  # Monday first
    day_periods: tuple[str, str, str, str]  # from 00, 06, 12 and 18 o'clock
    payment_groups: tuple[str, str, str, str]  # codes 0, 1, 2, any other
    duplicate_kinds: tuple[str, str, str]  # whole row, key, key in several files
    duplicate_patterns: tuple[str, str, str, str, str]  # pair, all < 0, same, different, other

    @property
    def reasons(self) -> list[str]:
        return [
            self.negative_total,
            self.negative_fare,
            self.dropoff_before_pickup,
            self.over_24h,
            self.outside_period,
            self.no_movement,
            self.distance_over_200,
            self.total_over_1000,
            self.duplicate,
        ]


# Fixed values.
SOURCE = Words(
    negative_total="reverso_monto_negativo",
    negative_fare="tarifa_negativa",
    dropoff_before_pickup="llegada_antes_de_salida",
    over_24h="duracion_mayor_24h",
    outside_period="fuera_del_periodo_del_archivo",
    no_movement="sin_movimiento",
    distance_over_200="distancia_mayor_200_millas",
    total_over_1000="total_mayor_1000",
    duplicate="duplicado",
    months=(
        "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
        "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
    ),
    weekdays=("Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"),
    day_periods=("Madrugada", "Mañana", "Tarde", "Noche"),
    payment_groups=("Flex Fare", "Tarjeta", "Efectivo", "Sin cobro, disputa u otro"),
    duplicate_kinds=("exactos", "por_clave", "por_clave_entre_archivos"),
    duplicate_patterns=(
        "par_original_y_reverso",
        "solo_negativos",
        "sin_negativos_mismo_monto",
        "sin_negativos_monto_distinto",
        "mixto_otro",
    ),
)

ENGLISH = Words(
    negative_total="negative_total",
    negative_fare="negative_fare",
    dropoff_before_pickup="dropoff_before_pickup",
    over_24h="over_24h",
    outside_period="outside_period",
    no_movement="no_movement",
    distance_over_200="distance_over_200",
    total_over_1000="total_over_1000",
    duplicate="duplicate",
    months=(
        "January", "February", "March", "April", "May", "June",
        "July", "August", "September", "October", "November", "December",
    ),
    weekdays=("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"),
    day_periods=("Night", "Morning", "Afternoon", "Evening"),
    payment_groups=("Flex Fare", "Card", "Cash", "No charge, dispute or other"),
    duplicate_kinds=("exact", "by_key", "by_key_across_files"),
    duplicate_patterns=(
        "original_and_reversal",
        "all_negative",
        "no_negative_same_amount",
        "no_negative_different_amount",
        "mixed_other",
    ),
)

# Text for the two special zones.
UNKNOWN_ZONE = 264
OUTSIDE_ZONE = 265
UNKNOWN_PLACE = "Unknown"
OUTSIDE_PLACE = "Outside of NYC"
NO_SERVICE_ZONE = "N/A"

# Outcome of one load attempt of one file.
LOADED = "LOADED"
SKIPPED = "SKIPPED"
NOT_AVAILABLE = "NOT_AVAILABLE"
FAILED = "FAILED"
