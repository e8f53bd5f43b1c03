"""Column functions for sites, alleles, genotypes and three-valued conditions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Contigs in order; the first 22 are autosomes.
CONTIGS = [*(f"chr{i}" for i in range(1, 23)), "chrX", "chrY"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Conditions. A missing predicate gives a missing result unless the caller opts out.


def if_else(p: Column, yes: Column, no: Column, missing_false: bool = False) -> Column:
    """yes or no by p; missing where p is missing, or `no` there with missing_false."""
    plain = F.when(p, yes).otherwise(no)
    return plain if missing_false else F.when(p.isNotNull(), plain)


def case(branches: list[tuple[Column, Column]], default: Column | None = None, missing_false: bool = False) -> Column:
    """First branch whose predicate holds; a missing predicate met before that gives missing unless missing_false."""
    out = F.lit(None) if default is None else default
    for p, value in reversed(branches):
        out = if_else(p, value, out, missing_false)
    return out


def or_missing(p: Column, x: Column) -> Column:
    return F.when(p, x)


def or_else(x: Column, d: Column) -> Column:
    return F.coalesce(x, d)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


# Alleles.


def is_star(alt: Column | str) -> Column:
    return col(alt) == "*"


def n_differing(ref: Column | str, alt: Column | str) -> Column:
    """Positions at which two strings of equal length differ."""
    r, a = col(ref), col(alt)
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(r), F.lit(1))), F.lit(0), lambda n, i: n + (F.substring(r, i, F.lit(1)) != F.substring(a, i, F.lit(1))).cast("int"))


def is_snp(ref: Column | str, alt: Column | str) -> Column:
    """Equal length, exactly one base differs, not the star allele; length one is decided without counting."""
    r, a = col(ref), col(alt)
    one = (F.length(r) == 1) & (r != a)
    return (F.length(r) == F.length(a)) & ~is_star(a) & F.when(F.length(r) == 1, one).otherwise(n_differing(r, a) == 1)


def is_mnp(ref: Column | str, alt: Column | str) -> Column:
    r, a = col(ref), col(alt)
    return (F.length(r) == F.length(a)) & (F.length(r) > 1) & (n_differing(r, a) > 1)


def is_insertion(ref: Column | str, alt: Column | str) -> Column:
    """The alternate allele keeps the reference's first base and ends with the rest of it."""
    r, a = col(ref), col(alt)
    return (F.length(r) < F.length(a)) & (F.left(r, F.lit(1)) == F.left(a, F.lit(1))) & a.endswith(F.substring(r, F.lit(2), F.length(r)))


def is_deletion(ref: Column | str, alt: Column | str) -> Column:
    r, a = col(ref), col(alt)
    return ~is_star(a) & is_insertion(a, r)


def is_indel(ref: Column | str, alt: Column | str) -> Column:
    return is_insertion(ref, alt) | is_deletion(ref, alt)


def is_complex(ref: Column | str, alt: Column | str) -> Column:
    r, a = col(ref), col(alt)
    return (F.length(r) != F.length(a)) & ~is_indel(r, a) & ~is_star(a)


def is_transition(ref: Column | str, alt: Column | str) -> Column:
    return F.concat(col(ref), col(alt)).isin("AG", "GA", "CT", "TC")


def is_transversion(ref: Column | str, alt: Column | str) -> Column:
    return is_snp(ref, alt) & ~is_transition(ref, alt)


def variant_class(ref: Column | str, alt: Column | str) -> Column:
    """SNP, INDEL or Other."""
    return F.when(is_snp(ref, alt), "SNP").when(is_indel(ref, alt), "INDEL").otherwise("Other")


def allele_type(ref: Column | str, alt: Column | str) -> Column:
    return F.when(is_star(alt), "star").when(is_snp(ref, alt), "snv").when(is_insertion(ref, alt), "ins").when(is_deletion(ref, alt), "del").otherwise("complex")


def variant_type(ref: Column, alts: Column) -> Column:
    """snv, multi-snv, indel, multi-indel or mixed over all alternates but the star."""
    kinds = F.array_distinct(F.transform(F.filter(alts, lambda a: a != "*"), lambda a: F.when(is_snp(ref, a), "snv").otherwise("indel")))
    many = F.size(F.filter(alts, lambda a: a != "*")) > 1
    return F.when(F.size(kinds) > 1, "mixed").when(many, F.concat(F.lit("multi-"), F.get(kinds, F.lit(0)))).otherwise(F.get(kinds, F.lit(0)))


def min_rep(position: Column | str, ref: Column | str, alt: Column | str) -> Column:
    """Minimal representation (position, ref, alt): common suffix cut first, then common prefix; one base stays."""
    p, r, a = col(position), col(ref), col(alt)
    most = F.least(F.length(r), F.length(a)) - 1

    def common(from_end: bool, x: Column, y: Column, limit: Column) -> Column:
        def same(i: Column) -> Column:
            at = (lambda s: F.substring(s, F.length(s) - i + 1, F.lit(1))) if from_end else (lambda s: F.substring(s, i, F.lit(1)))
            return at(x) == at(y)

        steps = F.when(limit > 0, F.sequence(F.lit(1), limit)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, F.lit(0), lambda n, i: F.when((n == i - 1) & same(i), i).otherwise(n))

    cut = common(True, r, a, most)
    r2, a2 = F.left(r, F.length(r) - cut), F.left(a, F.length(a) - cut)
    head = common(False, r2, a2, F.least(F.length(r2), F.length(a2)) - 1)
    rest = lambda s: F.substring(s, head + 1, F.length(s))
    return F.struct((p + head).alias("position"), rest(r2).alias("ref"), rest(a2).alias("alt"))


# Genotypes: n_alt is the number of alternate alleles of a diploid call, missing for no call.


def is_hom_ref(n_alt: Column | str) -> Column:
    return col(n_alt) == 0


def is_het(n_alt: Column | str) -> Column:
    return col(n_alt) == 1


def is_hom_var(n_alt: Column | str) -> Column:
    return col(n_alt) == 2


def is_non_ref(n_alt: Column | str) -> Column:
    return col(n_alt) > 0


def is_adj(n_alt: Column | str, gq: Column | str, dp: Column | str, ad_alt: Column | str) -> Column:
    """High-quality call: GQ >= 20, DP >= 10 and, for hets, an allele balance above 0.2."""
    balance = F.try_divide(col(ad_alt).cast("double"), col(dp).cast("double"))
    return (col(gq) >= 20) & (col(dp) >= 10) & (~is_het(n_alt) | (balance > 0.2))


# Calls as arrays of allele indices, with their phase; missing for no call.


def call_of(n_alt: Column | str, ploidy: int = 2) -> Column:
    """The unphased call with so many copies of the first alternate: the reference first."""
    n = col(n_alt).cast("int")
    return F.when(n.between(0, ploidy), F.transform(F.sequence(F.lit(1), F.lit(ploidy)), lambda i: F.when(i > ploidy - n, 1).otherwise(0)))


def unphased(alleles: Column | str) -> Column:
    """The alleles of a call without their order: sorted."""
    return F.array_sort(col(alleles))


def parse_call(text: Column | str) -> Column:
    """(alleles, phased) of text such as 0/1, 1|0 or 2; missing for text that has a missing allele or is no call."""
    t = col(text)
    alleles = F.transform(F.split(t, "[/|]"), lambda a: a.try_cast("int"))
    return F.when(F.coalesce(t.rlike(r"^[0-9]+(?:[/|][0-9]+)*$"), F.lit(False)), F.struct(alleles.alias("alleles"), t.contains("|").alias("phased")))


def same_call(alleles: Column | str, phased: Column | str, literal: str) -> Column:
    """Whether a call is the literal: phased calls are equal if their order is, unphased ones if their alleles are; the phase counts."""
    want = [int(x) for x in literal.replace("|", "/").split("/")]
    if "|" in literal:
        return col(phased) & (col(alleles) == F.array(*[F.lit(x) for x in want]))
    return (F.lit(len(want) == 1) | ~col(phased)) & (unphased(alleles) == F.array(*[F.lit(x) for x in sorted(want)]))


def is_het_ref(alleles: Column | str) -> Column:
    """A diploid call of the reference and one alternate."""
    a = col(alleles)
    return F.when(F.size(a) == 2, (F.array_min(a) == 0) & (F.array_max(a) > 0)).otherwise(F.when(a.isNotNull(), False))


# Loci.


def contig_rank(contig: Column | str) -> Column:
    """0-based place in CONTIGS, missing for an unknown contig."""
    at = F.array_position(F.array(*[F.lit(c) for c in CONTIGS]), col(contig))
    return F.when(at > 0, (at - 1).cast("int"))


def is_autosome(contig: Column | str) -> Column:
    return F.coalesce(contig_rank(contig) < 22, F.lit(False))


def parse_locus(text: Column | str) -> Column:
    part = F.split(col(text), ":")
    return F.struct(F.get(part, F.lit(0)).alias("contig"), F.get(part, F.lit(1)).try_cast("bigint").alias("position"))


def parse_variant(text: Column | str) -> Column:
    part = F.split(col(text), ":")
    return F.struct(*[F.get(part, F.lit(i)).alias(n) if n != "position" else F.get(part, F.lit(i)).try_cast("bigint").alias(n) for i, n in enumerate(("contig", "position", "ref", "alt"))])


def parse_interval(text: str) -> tuple[str, int, int]:
    """'chr1:10-20' or 'chr1' -> (contig, start, end), half-open."""
    contig, _, span = text.partition(":")
    if not span:
        return contig, 1, 2**31 - 1
    start, _, end = span.replace(",", "").partition("-")
    return contig, int(start), 2**31 - 1 if end in ("", "END") else int(end)


def in_intervals(contig: Column | str, position: Column | str, intervals: list[str]) -> Column:
    hits = [(col(contig) == c) & (col(position) >= s) & (col(position) < e) for c, s, e in map(parse_interval, intervals)]
    return any_of(hits)


# Numbers.


def to_phred(p: Column | str) -> Column:
    return F.when(col(p) > 0, -10 * F.log10(col(p)))


def from_phred(q: Column | str) -> Column:
    return F.pow(F.lit(10.0), -col(q) / 10)


def not_missing_marker(c: Column | str, marker: str = ".") -> Column:
    return F.nullif(col(c), F.lit(marker))


def binary_search(sorted_array: Column, x: Column) -> Column:
    """Number of elements below x: the place of x in an ascending array."""
    return F.size(F.filter(sorted_array, lambda v: v < x))
