"""almoner: Spark jobs that harmonize, unify, label and report on registries
of tax-exempt organizations."""
