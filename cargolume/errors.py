"""Typed failures raised by the jobs."""


class CargolumeError(Exception):
    """Base class."""


class MissingColumnsError(CargolumeError, ValueError):
    """An input lacks columns that the job needs."""


class UnknownCategoryError(CargolumeError, ValueError):
    """A category has no reference value."""


class IntegrityError(CargolumeError):
    """A table breaks a key, calendar or schema guarantee."""


class ThinCalibrationError(CargolumeError):
    """Too few observed shipments to calibrate a vehicle type."""


class InfeasiblePlanError(CargolumeError):
    """No allocation meets the fleet caps and the emission ceiling."""


class UnprovenPlanError(CargolumeError):
    """The search ended before a plan or its impossibility was proven."""


class VehicleEffectError(CargolumeError):
    """The vehicle moves the delay probability by more than the bound."""
