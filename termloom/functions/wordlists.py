"""Modifiers that are too general to open or carry on a term, alphabetically.

Fixed values: behaviour depends on them. Two entries beyond ASCII, a degree sign and a minus sign, are left out, as they never match a
token there either.
"""

GENERAL_MODIFIERS = tuple(
    r"""
% = above above-defined above-described above-mentioned acceptable according actual additional adjacent
affecting aforementioned allowing alternative anda appropriate available average being best better bottom
causing certain common comprising consecutive considerable consisting containing convenient conventional
correct corresponding current depending describing desirable detailed determining diagram different disclosing
displaying distinct double e.g. easy effective employing empty entire equal equivalent essential example
excellent excessive exemplary existing extensive external extra faster few fewer fifth fig final first
following foregoing forming fourth from\/to front further future general good greater greatest having
hereinafter high higher highest i.e. identical illustrated illustrating illustrative immediate important
improving in including increasing individual initial inner inside intermediate introducing involving known
large larger last later latter least left little longer low lower lowest m main major making many matching
middle mm modern more most multiple necessary new next normal novel numerous old only opposite optional
ordinary original other outer overall own part particular percent performing permissible permitting pertaining
positioning possible potential preceding predefined predetermined preferred preselected present previous
primary prior proper providing rear receiving recent regular relevant remaining requiring respective resultant
resulting right said same sample second select separate several shorter showing significant similar simple
sixth slight smaller so-called specific standard subjecting subsequent substantial successful successive such
sufficient suitable temporary terms therebetween third thus-obtained total type typical undesirable unique
unused unwanted upper use useful using valuable various varying version vertical well-known whence whole
""".split()
)
